"""The thin queries ``opN_<name>`` over whole standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, exact, html, latent, lines, negatives, packing, pii, quality, simhash, substrings, urls, whitening
from .common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql("""
        select cast(conv_id as long) conv_id, cast(turn as long) turn, role, '</s>[INST] ok [/INST]' text
        from values (-7, 0, 'user'), (-7, 1, 'assistant') as t(conv_id, turn, role)""")
    return chat.digests(chat.format_conversations(turns.union(extra)))


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    return quality.judge(table(spark, sf_dir, "documents"), trusted)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list, of which there is no table: the canonical URLs of all pages on
    hosts whose name joins words by a hyphen, as advertising hosts' names do."""
    pages = table(spark, sf_dir, "pages")
    host, path = urls.host_and_path(F.col("url"))
    listed = pages.where(F.contains(host, F.lit("-"))).select(urls.canonical(host, path).alias("canonical"))
    return urls.judge(pages, listed)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup(spark, f"{sf_dir}/documents.parquet")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


# what SQL can express of operators that it cannot express whole, through the same operators


def quality_base_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.base_counts(table(spark, sf_dir, "documents")).drop("w")


def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def whitening_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, fitted = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", F.lit(fitted.n if fitted else 0).cast("long").alias("n"), F.col("deviation").try_cast("long").alias("deviation"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_html_extract": op5_html_extract,
    "op6_best_fit": op6_best_fit,
    "op7_pii": op7_pii,
    "op8_quality": op8_quality,
    "op9_url_filter": op9_url_filter,
    "op10_simhash": op10_simhash,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_whitening": op12_whitening,
    "op13_hard_negatives": op13_hard_negatives,
    "quality_base_rules": quality_base_rules,
    "pii_base_spans": pii_base_spans,
    "whitening_deviations": whitening_deviations,
}

ORACLE_SQL = {
    "op3_substring_dedup": r"""
with w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
win as (select doc_id, unnest(range(0, greatest(len(w) - 12, 0))) as k, w from w),
h as (select doc_id, k, array_to_string(w[k + 1 : k + 13], ' ') as s from win),
f as (select s, min(doc_id) as first from h group by s),
late as (select doc_id, list(k) as ks from h join f using (s) where f.first < h.doc_id group by doc_id),
gone as (select doc_id, list_distinct(flatten(list_transform(ks, lambda k: range(k, k + 13)))) as g from late),
k as (select w.doc_id, w.w, coalesce(g, []) as g from w left join gone using (doc_id)),
kept as (select doc_id, len(w) as n_words, len(g) as n_removed, array_to_string(list_transform(list_filter(list_zip(w, range(0, len(w))), lambda x: not list_contains(g, x[2])), lambda x: x[1]), ' ') as t from k)
select doc_id, n_words::bigint as n_words, n_removed::bigint as n_removed, sha256(t) as kept_sha256 from kept
""",
    "op4_chat_format": r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (
  select *, replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') as r,
    replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') as x from t)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length(replace(r, chr(10), '&#10;')) + length(x) + length('<|im_start|>' || '<|im_end|>') + 2)::bigint as formatted_chars
from e group by conv_id
""",
    "op9_url_filter": r"""
with p as (
  select page_id, case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, regexp_extract(rest, '^([^/?#]*)', 1) as raw, rest from p),
u as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) as path from h),
r(rule, rule_host, rule_path, says) as (values ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
c as (select *, regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '^(?:www|m)\.', '') || regexp_replace(path, '/+$', '') as canonical from u),
listed as (select distinct canonical from c where contains(host, '-')),
best as (
  select page_id, arg_max(rule, length(rule)) as rule, arg_max(says, length(rule)) as says
  from u join r on (u.host = rule_host or ends_with(u.host, '.' || rule_host)) and starts_with(u.path, rule_path) group by page_id)
select c.page_id, host, path, rule,
  coalesce(says, case when canonical in (select canonical from listed) then 'block' else 'allow' end) as verdict
from c left join best using (page_id)
""",
    "op11_exact_dedup": r"""
with t as (
  select doc_id, length(coalesce(text, '')) as chars, translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') as bare from documents),
g as (select *, first_value(doc_id) over (partition by bare order by chars desc, doc_id) as keep_id, count(*) over (partition by bare) as group_size from t)
select doc_id, keep_id, group_size::bigint as group_size, doc_id = keep_id as kept, sha256(bare) as text_sha256 from g
""",
    "op13_hard_negatives": r"""
with v as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda c: floor(c::double * 256)) as x
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
s as (
  select a.id as anchor_id, v.id, v.label = a.label as same, list_dot_product(a.x, v.x)::bigint as score
  from v as a join v on a.id <> v.id where a.id % 100 = 0),
p as (
  select anchor_id, id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (
  select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, id)::int as rank,
    id as negative_id, positive_score, score as negative_score
  from p join s on p.anchor_id = s.anchor_id and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select * from n where rank <= 10
""",
    "quality_base_rules": r"""
with t as (
  select doc_id, coalesce(text, '') as t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
win as (
  select doc_id, unnest(range(0, greatest(len(w) - 7, 0))) as k,
    unnest(list_transform(range(0, greatest(len(w) - 7, 0)), lambda i: array_to_string(w[i + 1 : i + 8], ' '))) as words from t),
twice as (select doc_id, k from win qualify count(*) over (partition by doc_id, words) > 1),
places as (select doc_id, unnest(range(k, k + 8)) as p from twice),
covered as (select doc_id, count(distinct p) as n from places group by doc_id),
c as (
  select t.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines, coalesce(n, 0)::bigint as n_repeat_words
  from t left join covered using (doc_id))
select doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed
from c
""",
    "pii_base_spans": r"""
with t as (select doc_id, coalesce(text, '') as t from documents),
m as (
  select doc_id, 1 as k, 'email' as kind, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') as m, string_split_regex(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') as g from t
  union all select doc_id, 2, 'ip', regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), string_split_regex(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') from t
  union all select doc_id, 3, 'card', regexp_extract_all(t, '[0-9]([\x20-]?[0-9])+'), string_split_regex(t, '[0-9]([\x20-]?[0-9])+') from t
  union all select doc_id, 4, 'phone', regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), string_split_regex(t, '\+[0-9][\x20().0-9-]+[0-9]') from t),
each as (select *, unnest(range(1, len(m) + 1)) as i from m),
s as (
  select doc_id, k, kind, m[i] as found, regexp_replace(m[i], '[^0-9]', '', 'g') as digits,
    (coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0))::bigint as start
  from each),
good as (
  select doc_id, k, kind, start, start + length(found) as stop from s
  where k = 1
    or k = 2 and len(list_filter(string_split(found, '.'), lambda p: length(ltrim(p, '0')) > 3 or coalesce(try_cast(ltrim(p, '0') as int), 0) > 255)) = 0
    or k = 3 and length(digits) between 16 and 19 and list_sum(list_transform(range(0, length(digits)), lambda j:
      case when j % 2 = 0 then substr(reverse(digits), j + 1, 1)::int when substr(reverse(digits), j + 1, 1)::int > 4 then 2 * substr(reverse(digits), j + 1, 1)::int - 9
      else 2 * substr(reverse(digits), j + 1, 1)::int end)) % 10 = 0
    or k = 4 and length(digits) between 8 and 15),
a as (
  select doc_id, count(*) filter (where k = 1) as n_email, count(*) filter (where k = 2) as n_ip, count(*) filter (where k = 3) as n_card,
    count(*) filter (where k = 4) as n_phone, string_agg(kind || ':' || start || ':' || stop, ',' order by k, start) as spans
  from good group by doc_id)
select doc_id, coalesce(n_email, 0)::bigint as n_email, coalesce(n_ip, 0)::bigint as n_ip, coalesce(n_card, 0)::bigint as n_card,
  coalesce(n_phone, 0)::bigint as n_phone, sha256(coalesce(spans, '')) as base_sha256
from t left join a using (doc_id)
""",
    "whitening_deviations": r"""
with v as (
  select vec_id, list_transform(embedding, lambda c: floor(c::double * 256)::bigint) as x from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
d as (select distinct x from v),
total as (select count(*)::bigint as n from d),
sums as (select list(s order by j) as s from (select j, sum(x[j])::bigint as s from (select x, unnest(range(1, len(x) + 1)) as j from d) group by j))
select vec_id, n, list_sum(list_transform(list_zip(x, s), lambda p: ((n * p[1] - p[2]) * (n * p[1] - p[2]))::hugeint))::bigint as deviation from v, total, sums
""",
}
