"""Operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tramline.llm import chat, common, html, latent, lines, packing, pii, quality, simhash, substrings, urls
from tramline.llm.common import components, split_join
from tramline.llm.labelled_pages import labelled_pages

SCHEMA = "text string, doc_id long, bits long, block int, row string, `_gone` string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="module")
def texts():
    """Texts with copies, near copies, shared passages and the awkward cases."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdefgé") for _ in range(r.randint(1, 6))) for _ in range(300)]
    made = lambda n: " ".join(r.choice(vocabulary) + r.choice(("", "", ",", ".")) + r.choice(("", "", "", "\n")) for _ in range(n))
    shared = made(60)
    out = [(k, made(r.randint(5, 120))) for k in range(60)]
    out += [(100 + k, made(20) + "\n" + shared + "\n" + made(20)) for k in range(12)]
    out += [(200 + k, out[3][1]) for k in range(9)]  # exact copies
    out += [(300 + k, re.sub(r"^\S+", f"x{k}", out[7][1])) for k in range(6)]  # near copies
    out += [(400, None), (401, ""), (402, " \t\n"), (None, out[3][1]), (None, None), (5, out[5][1]), (404, "one"), (405, "word " * 5000), (406, "a" * 50_000)]
    return out


def frame(spark, rows, partitions=3):
    full = [(t, i, 7, 1, "r", "g") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 200), (200, 300), (300, 100), (7, 7), (500, 500), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {100: 100, 200: 100, 300: 100, 500: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_substrings_against_brute_force(spark, texts):
    got = substrings.dedup_substrings(frame(spark, texts), bundle_chars=4_000, keep_text=True).collect()
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, t in texts:
        w = words(t)
        for k in range(len(w) - 12):
            first[tuple(w[k : k + 13])] = min(first.get(tuple(w[k : k + 13]), float("inf")), key(i))
    expected = []
    for i, t in texts:
        w = words(t)
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < key(i):
                gone.update(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        expected.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    assert Counter(map(tuple, got)) == Counter(expected)
    assert sum(e[2] for e in expected) > 500
    assert substrings.dedup_substrings(frame(spark, [])).count() == 0
    short = [(None, None)] * 50 + [(1, "a b")] * 50  # bundles without any window
    got = Counter((x["doc_id"], x["n_words"], x["n_removed"]) for x in substrings.dedup_substrings(frame(spark, short), bundle_chars=10).collect())
    assert got == {(None, 0, 0): 50, (1, 2, 0): 50}


def test_substring_sizes_at_any_corpus():
    for chars in (0, 1, 10**6, 5 * 10**8, 3 * 10**10, 10**12, 10**14):
        bits, block, bundles, partitions, parts = substrings.sizes(chars)
        windows = chars / substrings.CHARS_A_WINDOW
        assert 2**bits >= 4 * windows and block <= substrings.BLOCK_MOST and partitions <= substrings.PARTITIONS
        rows = substrings.DEPTH * bundles * 2 ** (bits - block)
        # no more sketch rows than the stated share of windows, nor groups larger than a task holds
        assert chars < 10**7 or rows <= substrings.DEPTH * windows / substrings.WINDOWS_A_ROW * 1.1
        assert windows / parts < 10**8 and windows / 2 ** (bits - block) < 2**27


def test_sketch_never_underestimates(spark):
    texts = [(k, "same words here " * 30) for k in range(20)]
    got = substrings.dedup_substrings(frame(spark, texts), bundle_chars=500, depth=1).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {k: 90 if k else 0 for k in range(20)}


def slow_fingerprint(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    grams = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_against_brute_force(spark, texts):
    got = simhash.near_duplicates(frame(spark, texts)).collect()
    bits = [(i, slow_fingerprint(t)) for i, t in texts]
    parent = {b: b for _, b in bits}

    def find(b):
        return b if parent[b] == b else find(parent[b])

    for a in list(parent):
        for b in list(parent):
            if (a ^ b).bit_count() <= 4:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    smallest = {}
    for i, b in bits:
        if i is not None:
            smallest[find(b)] = min(smallest.get(find(b), i), i)
    assert Counter(map(tuple, got)) == Counter((i, f"{b:016x}", smallest.get(find(b))) for i, b in bits)
    kept = simhash.drop_near_duplicates(frame(spark, texts), similarity=0.999).collect()
    assert Counter((x["doc_id"], x["text"]) for x in kept if x["doc_id"] is None) == Counter((i, t) for i, t in texts if i is None)
    same = {}
    for i, t in texts:
        if i is not None:
            same.setdefault(" ".join(words(t)), i)
    assert {x["doc_id"] for x in kept} <= {None, *same.values()} and {x["doc_id"] for x in kept} >= {None, *(i for i, _ in texts[:60])} - {5}


def test_simhash_finds_every_close_pair(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(40)]
    values = sorted({b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 6))) for b in base for _ in range(25)})
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.links(spark.createDataFrame(signed, "bits long"))
    got = {x["node"]: x["component"] for x in components(links).collect()}
    parent = {v: v for v, in signed}

    def find(b):
        return b if parent[b] == b else find(parent[b])

    for k, (a,) in enumerate(signed):
        for b, in signed[k + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {v: got.get(v, v) for v, in signed} == {v: find(v) for v, in signed}


@pytest.mark.parametrize("words_", [1, 2])
def test_simhash_cuts_large_cells(spark, words_):
    # all in one cell of the lower half; in the upper one, and in further words, at random
    r = random.Random(19)
    prints = sorted({tuple(r.getrandbits(32) << 32 | 0x33333333 if k == 0 else r.getrandbits(6) for k in range(words_)) for _ in range(3_000)})
    prints = [p for p in prints for p in ((p[0], *p[1:]), (p[0] ^ 1 << r.randint(32, 63) ^ 1 << r.randint(32, 63), *p[1:]))]
    prints = sorted(set(prints))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    rows = spark.createDataFrame([tuple(map(signed, p)) for p in prints], ", ".join(f"w{k} long" for k in range(words_)))
    got = [{x["node"]: x["component"] for x in components(simhash.links(rows, 4, n)).collect()} for n in (10**6, 500)]
    assert got[0] == got[1] and len(got[0]) > 5_000 and len(set(got[0].values())) > 100


def test_simhash_cell_of_many_fingerprints(spark):
    # 200,000 fingerprints whose lower halves are one point, linked in pairs
    ids = spark.range(100_000).select((F.xxhash64("id").bitwiseAND(F.lit(-(1 << 32))) + F.lit(0x33333333)).alias("w0"))
    both = ids.union(ids.select(F.col("w0").bitwiseXOR(F.lit(3 << 40)))).distinct()
    found = components(simhash.links(both)).groupBy("component").count()
    nodes = found.agg(F.sum("count").alias("n")).head()["n"]
    assert nodes == both.count() and found.count() < 100_000


def test_near_duplicates_by_similarity(spark):
    r = random.Random(21)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(2000)]
    docs, pairs = [], {}
    for k in range(900):
        w = [r.choice(vocabulary) for _ in range(300)]
        copy = list(w)
        for j in r.sample(range(300), r.choice((0, 1, 2, 3, 4, 5, 6, 6, 6, 7, 8, 9, 12))):
            copy[j] = "other"
        grams = lambda x: {tuple(x[j : j + 5]) for j in range(296)}
        pairs[k] = len(grams(w) & grams(copy)) / len(grams(w) | grams(copy))
        docs += [(k, " ".join(w)), (2000 + k, " ".join(copy))]
    left = {x["doc_id"] for x in simhash.drop_near_duplicates(frame(spark, docs)).collect()}
    assert set(range(900)) <= left
    share = lambda low, high: sum(2000 + k not in left for k, j in pairs.items() if low <= j < high) / sum(low <= j < high for j in pairs.values())
    found = {low: share(low, low + 0.05) for low in (0.8, 0.85, 0.9, 0.95)}
    print(found)
    assert min(found.values()) >= 0.9 and share(0.5, 0.8) == 0


def test_near_duplicate_links_are_verified(spark):
    # a family of texts between which links lie just above and well below the mark, of which some share a fingerprint
    r = random.Random(22)
    base = [f"w{r.randint(0, 10**6)}" for _ in range(200)]
    docs = []
    for k in range(60):
        w = list(base)
        for j in r.sample(range(200), r.choice((2, 3, 8))):
            w[j] = f"x{r.randint(0, 10**6)}"
        docs.append((k, " ".join(w)))
    long = " ".join(["a b c d e f g"] * 60)
    docs += [(100, long + " one two three four five"), (101, long + " six seven eight nine ten"), (102, long + " one two three four five"), (103, None), (104, " \n"), (None, docs[0][1])]
    grams = lambda t: {tuple(w[j : j + 5]) for w in [(t or "").split()] for j in range(max(len(w) - 4, min(len(w), 1)))}
    alike = lambda a, b: len(a & b) * 5 >= 4 * len(a | b)
    sets = {i: grams(t) for i, t in docs if i is not None}
    got = {x["doc_id"]: x["component_id"] for x in simhash.similar_groups(frame(spark, docs)).collect()}
    # every group hangs together by real links
    for head in set(got.values()):
        group, reached, todo = {i for i, c in got.items() if c == head}, {head}, [head]
        while todo:
            i = todo.pop()
            new = {j for j in group - reached if alike(sets[i], sets[j])}
            reached |= new
            todo += new
        assert reached == group
    assert got[102] == 100 and got[101] == 101 and got[104] == 103
    linked = [(i, j) for i, j in itertools.combinations(range(60), 2) if alike(sets[i], sets[j])]
    assert linked and sum(got[i] == got[j] for i, j in linked) >= 0.9 * len(linked)


def test_patience_and_line_dedup(spark):
    assert lines.patience("abcde", "xbcyde") == [(1, 1), (2, 2), (3, 4), (4, 5)]
    assert lines.patience("", "a") == [] and lines.patience("aa", "aa") == [(0, 0), (1, 1)]
    r = random.Random(2)
    for _ in range(200):
        a, b = ([r.randint(0, 6) for _ in range(r.randint(0, 12))] for _ in range(2))
        pairs = lines.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    long = ["alpha beta gamma delta epsilon zeta", "eta theta iota kappa lambda mu", "nu xi omicron pi rho sigma tau"]
    docs = [
        (1, "\n".join(["first own line"] + long)), (2, "\n".join(long[:2] + ["second own line"])), (3, "short\nother own words"), (4, "short\n\nyet more"),
        (5, None), (6, ""), (None, "\n".join(long)), (7, "\n".join(long)), (7, "\n".join(long)), (8, "one\n" + "\r\n".join(long)),
    ]
    out = lines.dedup_lines(frame(spark, docs)).select("doc.doc_id", "kept").collect()
    got = Counter(map(tuple, out))
    assert got == Counter([(1, docs[0][1]), (2, "second own line"), (3, docs[2][1]), (4, docs[3][1]), (5, None), (6, ""), (None, docs[6][1]), (7, ""), (7, ""), (8, "one")])
    assert lines.dedup_lines(frame(spark, [])).count() == 0


def test_patience_aligns_gaps_without_unique_lines():
    r = random.Random(12)
    for _ in range(300):
        a, b = ([r.randint(0, 4) for _ in range(r.randint(0, 14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        for bits in (1, 20, lines.GAP_BITS):
            pairs = lines.common(a, b, bits)
            assert len(pairs) == table[-1][-1] and all(a[i] == b[j] for i, j in pairs)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert len(lines.patience("xpqry", "ipqrmpqro")) == 3
    # a passage held twice goes twice, and a moved one goes
    assert lines.removed_lines("xpqry", "ipqrmpqro", [5] * 9) == [1, 2, 3, 5, 6, 7]
    assert lines.removed_lines("pqrsxt", "xtpqrs", [5] * 6) == [0, 1, 2, 3, 4, 5]
    assert lines.removed_lines("pq", "qxp", [5] * 3) == []


def test_line_dedup_against_all_earlier_documents(spark):
    r = random.Random(13)
    pool = [" ".join(f"w{k}" for _ in range(1 + k % 6)) for k in range(10)]
    n = lambda x: len(words(x))
    docs = [(k, "\n".join(r.choice(pool) for _ in range(r.randint(1, 9)))) for k in range(60)]
    # each line of the shared block has an earlier holder of its own
    block = ["one two three four", "five six seven", "eight nine ten", "eleven twelve"]
    docs += [(100 + k, f"own {k}\n{x}\nend {k}") for k, x in enumerate(block)] + [(200 + k, "\n".join([f"top {k}", *block, f"tail {k}"])) for k in range(3)]
    expected = {}
    for i, t in docs:
        own = t.split("\n")
        aligned, shared = set(), set()
        for k, u in docs:
            if k < i:
                aligned.update(lines.removed_lines(u.split("\n"), own, [n(x) for x in own]))
                other = "\n" + u + "\n"
                for s in range(len(own)):
                    for e in range(s, len(own)):
                        if sum(map(n, own[s : e + 1])) >= 10 and "\n" + "\n".join(own[s : e + 1]) + "\n" in other:
                            shared.update(range(s, e + 1))
        assert aligned == shared
        expected[i] = sorted(shared)
    assert expected[201] == expected[202] == [1, 2, 3, 4] and expected[200] == []
    assert sum(map(len, expected.values())) > 40
    got = lines.dedup_lines(frame(spark, docs)).select("doc.doc_id", "gone").collect()
    assert {x["doc_id"]: sorted(x["gone"] or []) for x in got} == expected


@pytest.mark.parametrize("rows", [50, 90, 150, 300])
def test_line_dedup_is_the_same_at_every_size(spark, rows):
    # a block of short lines that all hold, and one that two hold whose lines have other first holders
    block = ["a line of six words here", "and six more words after it"]
    docs = [(k, "\n".join([f"own {k}", *block])) for k in range(rows)]
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    docs += [(1001, f"x\n{a}"), (1002, f"y\n{b}"), (1003, f"z\n{a}\n{b}"), (1004, f"v\n{a}\n{b}"), (1005, f"own\n{b}\n{a}")]
    got = {x["doc"]["doc_id"]: x["kept"] for x in lines.dedup_lines(frame(spark, docs)).collect()}
    assert got == {0: docs[0][1]} | {k: f"own {k}" for k in range(1, rows)} | dict(docs[rows : rows + 3]) | {1004: "v", 1005: docs[-1][1]}


def test_line_dedup_awkward_rows(spark):
    passage = "\n".join(f"line {k} of a long passage" for k in range(3000))
    docs = [(1, passage), (2, "top\n" + passage + "\n" + passage), (2, "other text of id two\n" + passage), (3, "x" * 300_000), (4, "x" * 300_000), (5, "a b c d e f g h i j\n\n" * 2000), (None, passage), (None, passage), (None, None)]
    out = lines.dedup_lines(frame(spark, docs)).select("doc.*", "kept").collect()
    got = Counter((x["doc_id"], x["kept"]) for x in out)
    assert got == Counter([(1, passage), (2, "top"), (2, "other text of id two"), (3, docs[3][1]), (4, docs[4][1]), (5, docs[5][1]), (None, passage), (None, passage), (None, None)])
    assert out[0]["bits"] == 7 and out[0]["row"] == "r"


def test_split_join(spark):
    many = spark.range(20_000).selectExpr("if(id % 3 = 0, 7, id) as k", "id as other")
    one = many.select("k").distinct().selectExpr("k", "k * 2 as twice")
    counts = many.groupBy("k").count().withColumnRenamed("count", "n")
    got = split_join(many, one, "k", counts, F.col("other"))
    assert got.count() == 20_000 and got.where("twice <> 2 * k or k is null").count() == 0


def test_packing_against_piece_by_piece():
    r = random.Random(3)
    for _ in range(20):
        sizes = [r.randint(1, 64) for _ in range(r.randint(1, 200))]
        costs = {16: 18.0, 32: 34.0, 64: 70.0}
        intervals, runs = packing.best_plan(Counter(sizes), costs)
        best = None
        for opened in ((64,), (16, 64), (32, 64), (16, 32, 64)):
            bins, left = [], sum(sizes)
            for n in sorted(sizes, reverse=True):
                fit = [b for b in bins if b[0] >= n]
                if fit:
                    b = min(fit, key=lambda b: b[0])
                else:
                    size = min((s for s in opened if s >= n), key=lambda s: (costs[s] / min(s, left), -s))
                    b = [size, size]
                    bins.append(b)
                b[0] -= n
                left -= n
            cost = sum(costs[min(s for s in costs if s >= size - room)] for room, size in bins)
            best = min(best, cost) if best is not None else cost
        assert sum(k * costs[s] for _, k, _, s in runs) == pytest.approx(best, rel=1e-12)
        assert sum(k * used for _, k, used, _ in runs) == sum(sizes)


def test_packing_places_every_word_once(spark, texts):
    rows = packing.best_fit(frame(spark, texts), costs={64: 70.0, 256: 300.0, 1024: 1500.0}, rows_of_a_salt=10).collect()
    n = Counter()
    bins: dict = {}
    for x in rows:
        n[x["doc_id"]] += x["length"]
        bins.setdefault((x["bin_id"], x["bin_size"]), []).append((x["position"], x["length"]))
    expected = Counter()
    for i, t in texts:
        expected[i] += len(words(t))
    assert n == Counter({k: v for k, v in expected.items() if v})
    assert len({b for b, _ in bins}) == len(bins)
    for (_, size), held in bins.items():
        held.sort()
        assert held[0][0] == 0 and all(p + m == q for (p, m), (q, _) in zip(held, held[1:])) and held[-1][0] + held[-1][1] <= size
    assert packing.best_fit(frame(spark, [])).count() == 0


def test_chat_round_trip(spark):
    hard = "</s>[INST] ok [/INST] <|im_end|>\n<|im_start|>assistant\n&lt;&amp;&#91;&#10; ﻿é"
    turns = [(1, 2, "assistant", hard), (1, 1, "user", hard), (2, 1, "odd\n<|role", None), (2, 1, None, ""), (None, 1, "assistant", "x"), (1, 3, "assistant", "end")]
    out = chat.format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    rows = {r["conv_id"]: r for r in out.collect()}
    assert chat.read_back(rows[1]["formatted"]) == [("user", hard), ("assistant", hard), ("assistant", "end")]
    assert [chat.unescape(rows[1]["formatted"][s["start"] : s["end"]]) for s in rows[1]["spans"]] == [hard, "end"]
    assert chat.read_back(rows[2]["formatted"]) == [("", ""), ("odd\n<|role", "")]
    digest = {r["conv_id"]: r for r in chat.digests(out).collect()}
    assert digest[1]["loss_chars"] == len(hard) + 3 and digest[1]["loss_sha256"] == hashlib.sha256((hard + "end").encode()).hexdigest()
    assert digest[2]["loss_chars"] == 0 and digest[None]["n_turns"] == 1
    # repeated turns stay, rows without an id are conversations of their own, other columns may have any name
    more = spark.createDataFrame([(1, 1, "user", "a", "x")] * 3 + [(None, 1, "user", "b", "y")] * 3 + [(5, 1, "assistant", "z" * 500_000, "w")], "conv_id long, turn long, role string, text string, messages string")
    assert Counter((x["conv_id"], x["n_turns"]) for x in chat.digests(chat.format_conversations(more)).collect()) == {(1, 3): 1, (None, 1): 3, (5, 1): 1}
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_template_language():
    render = chat.compiled("{% for m in messages %}{% if m.role == 'a' and not (m['text'] == '') %}A{{ m.text | upper }}{% elif m.role != 'b' %}-{% else %}B{% endif %}{% endfor %}{{ 'x' + 1 }}")
    assert render([{"role": "a", "text": "q"}, {"role": "a", "text": ""}, {"role": "b", "text": ""}])[0] == "AQ-Bx1"
    assert chat.simplified(chat.parsed("{% if 1 == 2 %}no{% else %}{{ 'a' + 'b' | upper }}{% endif %}!")) == [("text", "aB!")]
    for bad in ("{{ m.__class__ }}", "{{ messages.x }}"):
        with pytest.raises(chat.TemplateError):
            chat.compiled(bad)([{"role": "a", "text": ""}])
    for bad in ("{% for m in messages %}", "{{ x | open }}", "{{ (1 }}", "{% endif %}", "{{ }}", "{{ 1 ; 2 }}"):
        with pytest.raises(chat.TemplateError):
            chat.compiled(bad)


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def slow_identifiers(t):
    def ok(kind, m):
        d = [int(c) for c in m if c.isdigit()]
        luhn = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d))) % 10 == 0
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.split(".")), "card": 16 <= len(d) <= 19 and luhn, "phone": 8 <= len(d) <= 15}[kind]

    return [(k, *m.span()) for k, p in BASE.items() for m in p.finditer(t) if ok(k, m[0])]


def test_pii_base_against_patterns():
    r = random.Random(4)
    parts = ["a@b.c", "@", ".", "1.2.3.4", "256", "+1 (234) 555-6789", "4041894974608795", " ", "-", "x", "é", "12", "+", "..", "%a"]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 9)))
        assert pii.identifiers(t) == slow_identifiers(t)


@pytest.mark.parametrize(("text", "kind", "found"), [
    ("write bob.smith [at] mail (dot) example dot com now", "email", "bob.smith [at] mail (dot) example dot com"),
    ("x bob at example dot com", "email", "bob at example dot com"),
    ("jаne@exаmple.com", "email", "jаne@exаmple.com"),
    ("ｊane＠example．com", "email", "ｊane＠example．com"),
    ("call plus one four one five five five five two six seven one", "phone", "plus one four one five five five five two six seven one"),
    ("４０４１ 8949 7460 8795", "card", "４０４１ 8949 7460 8795"),
    ("at 192 [.] 168 (dot) 1 dot 20 ok", "ip", "192 [.] 168 (dot) 1 dot 20"),
    ("us​er@ho​st.org", "email", "us​er@ho​st.org"),
])
def test_pii_disguises(text, kind, found):
    more = pii.disguised(text, pii.identifiers(text))
    assert [(k, text[s:e]) for k, s, e in more] == [(kind, found)]


def test_pii_gate_is_a_necessary_condition(monkeypatch):
    r = random.Random(15)
    parts = [*pii.SPELLED, *pii.SAID, "4", "155", "+", "prose", "Eight", "point", "dash", "one", "+one", "plusfour"]
    texts = ["eight point eight point eight point eight", "plus one 4 one 5 five 5 six 7 eight 9", "plus four dash nine dash three dash zero dash one dash two dash three dash four"]
    made = texts + ["".join(r.choice(parts) + r.choice((" ", " ", ", ", "-", "")) for _ in range(r.randint(4, 16))) for _ in range(3000)]
    got = [pii.disguised(t, pii.identifiers(t)) for t in made]
    assert [[k for k, _, _ in x] for x in got[:3]] == [["ip"], ["phone"], ["phone"]]
    monkeypatch.setattr(pii, "QUICK", re.compile(""))
    assert got == [pii.disguised(t, pii.identifiers(t)) for t in made]
    assert sum(map(bool, got)) > 10


def slow_disguised(text, base):
    """Character by character, with every pair of spans compared."""
    spans, changed, t = [(k, k + 1) for k in range(len(text))], [False] * len(text), text

    def apply(edits):
        nonlocal spans, changed, t
        out_t, out_s, out_c, at = "", [], [], 0
        for s, e, new in [*edits, (len(t), len(t), None)]:
            out_t, out_s, out_c = out_t + t[at:s], out_s + spans[at:s], out_c + changed[at:s]
            if new:
                out_t, out_s, out_c = out_t + new, out_s + [(spans[s][0], spans[e - 1][1])] * len(new), out_c + [True] * len(new)
            elif e > s and out_c:
                out_c[-1] = True
            at = e
        t, spans, changed = out_t, out_s, out_c

    class Slow:
        text = property(lambda _: t)

        def apply(self, edits):
            apply(list(edits))

    pii.homoglyphs(Slow())
    pii.spelled_digits(Slow())
    pii.at_and_dot(Slow())
    out = []
    for k, s, e in slow_identifiers(t):
        a, b = spans[s][0], spans[e - 1][1]
        if any(changed[s:e]) and not any(k == k2 and a2 < b and a < b2 for k2, a2, b2 in base + out):
            out.append((k, a, b))
    return out


def test_pii_added_spans_against_character_by_character():
    r = random.Random(17)
    parts = ["bob", "a.b", " at ", " [at] ", "(at)", " dot ", "[dot]", "(.)", "@", ".", "com", "org", "1", "192", ".", "one", " ", "two ", "plus ", "＠", "．", "а", "​", "​​", "４", "+", "-", "x1.2.3.4", "é", "\n"]
    found = 0
    for _ in range(20_000):
        t = "".join(r.choice(parts) for _ in range(r.randint(2, 14)))
        base = pii.identifiers(t)
        assert pii.disguised(t, base) == slow_disguised(t, base), t
        found += len(pii.disguised(t, base))
    assert found > 500


@pytest.mark.parametrize("unit", ["10.20.30.40 ", "bob [at] mail.org, ", "a dot b dot ", "x at y. ", "jаne@exаmple.com ", "one two three four five ", "[at] ", "a" * 60 + ".", "４", "​", "+1 555 (dot) "])
def test_pii_long_texts_take_linear_time_and_little_memory(unit):
    import time
    import tracemalloc

    text = "one [dot] here " + unit * (1_000_000 // len(unit))
    base = pii.identifiers(text)
    began = time.perf_counter()
    found = pii.disguised(text, base)
    assert time.perf_counter() - began < 6  # seconds; 0.3 to 2 where nothing else runs
    if unit == "10.20.30.40 ":
        assert found == []
        tracemalloc.start()
        pii.Rewritten(text).apply([(4, 9, ".")])
        assert tracemalloc.get_traced_memory()[1] < 10 * len(text)
        tracemalloc.stop()


def test_pii_leaves_prose_alone(spark):
    clean = "We meet at noon. Look at the dot on page one, two and three; e.g. at example.com. Größe, été, niño"
    rows = [(1, clean), (2, None), (3, ""), (None, "a@b.co"), (4, "a@b.co and c [at] d.org")]
    got = {r["doc_id"]: r for r in pii.find_pii(frame(spark, rows)).collect()}
    assert got[1]["spans"] == got[2]["spans"] == got[3]["spans"] == "" and got[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[None]["spans"] == "email:0:6"
    assert got[4]["spans"] == "email:0:6,email:11:23" and got[4]["n_email"] == 1 and got[4]["n_added"] == 1
    assert pii.find_pii(frame(spark, [])).count() == 0


def test_quality_against_brute_force(spark, texts):
    labels = spark.createDataFrame([(k,) for k in range(30)] + [(None,), (3,)], "doc_id long")
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in quality.judge(frame(spark, texts), labels).collect())
    expected = []
    for i, t in texts:
        w, t = words(t), t or ""
        c = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        again = {p for k in range(len(w) - 7) if c[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
        own = [x for x in t.split("\n") if words(x)]
        expected.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(own) - len(set(own)), len(again), len(w) < 20 or 100 * len(again) > 30 * len(w)))
    assert got == Counter(expected)
    none = quality.judge(frame(spark, texts), labels.where("doc_id < 0"))
    assert {r["kept"] for r in none.where("not base_failed").collect()} == {True}
    assert quality.judge(frame(spark, []), labels).count() == 0


def test_quality_scores_against_brute_force(spark, texts):
    import math

    buckets = 512
    pairs = [(w, f) for _, t in texts for w, f in zip(words(t), [*words(t)[1:], ""])]
    rows = spark.createDataFrame(list(set(pairs)), "w string, f string")
    hashed = rows.select("w", "f", quality.of_word(F.col("w"), F.col("f"), buckets).alias("b")).collect()
    at = {(x["w"], x["f"]): x["b"] for x in hashed}
    features = lambda t: [b for p in zip(words(t), [*words(t)[1:], ""]) for b in at[p]]
    raw, target = Counter(), Counter()
    for i, t in texts:
        raw.update(features(t))
        target.update(features(t) if i is not None and i < 30 else [])
    scale = raw.total() / target.total()
    ratio = {b: math.log((target[b] * scale + 4) / (raw[b] + 4)) for b in raw}
    expected = sorted((i is None, i or 0, round(sum(ratio[b] for b in features(t)) / max(1, len(features(t))), 9)) for i, t in texts)
    labels = spark.createDataFrame([(k,) for k in range(30)] + [(None,), (3,)], "doc_id long")
    got = quality.judge(frame(spark, texts), labels, buckets=buckets).collect()
    assert sorted((x["doc_id"] is None, x["doc_id"] or 0, round(x["score"], 9)) for x in got) == expected
    assert all(x["kept"] == (not x["base_failed"] and x["score"] >= quality.THRESHOLD) for x in got)
    # both ways to mark the target give one model
    few, many = (quality.model(frame(spark, texts), labels, buckets=buckets, broadcast_ids=n).head()["ratios"] for n in (10**6, 0))
    assert few == many and any(few)


def test_quality_verdicts_agree(spark):
    good = [(k, " ".join(f"w{(k * 7 + j * j) % 90}" for j in range(60))) for k in range(40)]
    bad = [(100 + k, " ".join(f"q{(k + j * j) % 90}%%%" for j in range(60))) for k in range(10)]
    docs = frame(spark, good + bad)
    labels = spark.createDataFrame([(k,) for k in range(40)], "doc_id long")
    kept = {r["doc_id"] for r in quality.judge(docs, labels).where("kept").collect()}
    assert kept == set(range(40))
    left = quality.drop_rejected(docs.withColumn("ratios", F.lit(3)).withColumn("a.b", F.lit("c")), labels).collect()
    assert {r["doc_id"] for r in left} == kept and {(r["ratios"], r["a.b"], r["bits"]) for r in left} == {(3, "c", 7)}


def test_urls(spark):
    pages = [
        (1, "https://WWW.Spam.net/a/?x=1#y"), (2, "http://m.spam.net/a"), (3, "https://spam.net/b"), (4, "x://a.example.org/es/q"), (5, "x://example.org/en/1?z"),
        (6, "x://example.org/en/2"), (7, "x://b.com/fr/"), (8, "x://b.com/de/"), (9, "x://notcom/fr/"), (10, None), (11, "no scheme"), (12, "x://h?p/q"), (13, "x://org"), (2, "http://m.spam.net/a"),
    ]
    listed = spark.createDataFrame([("spam.net/a",), ("spam.net/a",), (None,), ("other.net",)], "canonical string")
    frame_ = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, canonical string")
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(frame_, listed).collect())
    assert got == Counter({
        (1, "www.spam.net", "/a/", None, "block"): 1, (2, "m.spam.net", "/a", None, "block"): 2, (3, "spam.net", "/b", None, "allow"): 1,
        (4, "a.example.org", "/es/q", "example.org/es/", "block"): 1, (5, "example.org", "/en/1", "example.org/en/1", "block"): 1, (6, "example.org", "/en/2", "org/", "allow"): 1,
        (7, "b.com", "/fr/", "com/fr/", "allow"): 1, (8, "b.com", "/de/", "com/de/", "block"): 1, (9, "notcom", "/fr/", None, "allow"): 1, (10, "", "", None, "allow"): 1,
        (11, "", "", None, "allow"): 1, (12, "h", "", None, "allow"): 1, (13, "org", "", None, "allow"): 1,
    })
    assert urls.judge(frame_, listed.where("false")).where("verdict = 'block'").count() == 3
    long = "x://Host.net/" + "a/" * 100_000
    rows = [(1, long), (2, long + "b"), (3, "x://a.b.org/q")]
    tied = (("b.org/", "b.org", "/", "block"), ("a.org/", "org", "/", "allow"))
    assert [r["verdict"] for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame([("host.net" + "/a" * 100_000,)], "canonical string"), tied).orderBy("page_id").collect()] == ["block", "allow", "block"]
    assert urls.judge(frame_.where("false"), listed).count() == 0


def test_frequent_urls(spark, monkeypatch):
    # a third of all pages without a URL, a third of one listed URL: dealt over tasks, verdicts alike
    monkeypatch.setattr(common, "TASK_ROWS", 1_000)
    url = "case when id % 3 = 0 then null when id % 3 = 1 then 'x://hot.net/a' else concat('x://h', id, '.net/') end"
    pages = spark.range(30_000).selectExpr("id as page_id", f"{url} as url")
    listed = spark.createDataFrame([("hot.net/a",), ("h5.net",), ("elsewhere.net",)], "canonical string")
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        out = urls.judge(pages, listed)
        tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        got = out.groupBy("host", "verdict").count().where("host in ('', 'hot.net', 'h5.net') or verdict = 'block'").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got)) == [("", "allow", 10_000), ("h5.net", "block", 1), ("hot.net", "block", 10_000)]
    assert sum(tasks) == 30_000 and max(tasks) < 6_000
    empty = urls.judge(pages, spark.createDataFrame([("",)], "canonical string"))
    assert [tuple(r) for r in empty.groupBy("verdict").count().orderBy("verdict").collect()] == [("allow", 20_000), ("block", 10_000)]


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(2000).selectExpr("concat('k', id) as key")
    filtered = urls.may_contain(spark.range(8000).selectExpr("concat('k', id) as key", "id"), "key", urls.bloom(keys, "key", 125), 125)
    assert filtered.where("id < 2000 and not possible").count() == 0
    assert filtered.where("id >= 2000 and possible").count() < 300


def test_html_blocks():
    text = lambda h: [b.text for b in html.blocks_of(h)]
    assert text('<title>t</title><script>"</p>"</script><p>a &amp; b<br>c<p>d  <i>e</i>\n f</p><!-- x -->g<li>h') == ["a & b c", "d e f", "g", "h"]
    assert text("<head><p>kept</p>") == ["kept"] and text("") == [] and text("<p") == [] and text("a<b>c</b>") == ["ac"]
    assert text("<select><option>no</select><p title='>'>yes") == ["yes"]


def test_html_raw_elements_that_close_themselves_or_nothing_closes():
    text = lambda h: [b.text for b in html.blocks_of(h)]
    for tag in ('<svg class="icon"/>', '<svg/>', '<svg hidden />', '<iframe src="x" />', "<object data='y'/>", '<script src="z"/>', "<svg>", "<noscript>", "<select><option>", "<iframe src=a/>", "<template>", "<object>"):
        assert text(f"<article><p>one</p>{tag}<p>two</p><div>three</div></article><p>four")[-4:] == ["one", "two", "three", "four"]
    # what is closed stays raw, whatever it holds
    for raw in ("<noscript><p>no</p></noscript>", "<svg><title>no</title><foreignObject><div>no</div></foreignObject></svg>", "<object><object><p>no</p></object><p>no</p></object>", "<script src=/a/>no</script>", "<select><option>no<option>no</select>"):
        assert text(f"<p>one</p>{raw}<p>two</p>") == ["one", "two"]
        assert text(f"<p>one</p><svg>{raw}<p>two</p>") == ["one", "two"]


def test_html_held_out_accuracy():
    field = html.fitted()
    right = total = 0
    for page, labels in labelled_pages(150, seed=77):
        blocks = html.blocks_of(page)
        assert len(blocks) == len(labels)
        right += sum(a == b for a, b in zip(field.decode(blocks), labels, strict=True))
        total += len(labels)
    assert right / total > 0.98


def chain_scores(field, blocks):
    """The score of every labelling of a page, by enumeration."""
    each = [sum((field.weights[field.index[x]] for x in f if x in field.index), np.zeros(2)) for f in html.features(blocks)]
    return {y: sum(e[c] for e, c in zip(each, y)) + sum(field.pairs[a, b] for a, b in zip(y, y[1:])) for y in itertools.product((0, 1), repeat=len(each))}


def test_html_viterbi_against_enumeration():
    r, field = random.Random(25), html.fitted()
    tags = ["p", "li", "h1", "footer", "nav", "div class='ad'", "article", "aside"]
    for _ in range(60):
        page = "".join(f"<{(t := r.choice(tags))}>{'word ' * r.randint(1, 30)}<a href=x>{'link ' * r.randint(0, 4)}</a></{t.split()[0]}>" for _ in range(r.randint(1, 9)))
        blocks = html.blocks_of(page)
        scores = chain_scores(field, blocks)
        assert scores[tuple(field.decode(blocks))] == pytest.approx(max(scores.values()), abs=1e-9)


def test_html_fit_against_enumeration():
    pages = [(f"<p>{'a ' * n}.</p><nav>{'b ' * k}</nav><p>c</p>", (1, 0, y)) for n, k, y in ((9, 2, 1), (3, 5, 0), (20, 1, 1), (1, 1, 0))] + [("<p>only one block here</p>", (1,))]
    index, value = html.likelihood(pages)
    r = np.random.default_rng(4)

    def enumerated(w):
        """The penalised likelihood and its gradient by all labellings."""
        field = html.Field(index, w[:-4].reshape(-1, 2), w[-4:].reshape(2, 2))
        total, gap, pairs = 0.0, np.zeros_like(field.weights), np.zeros((2, 2))
        for page, truth in pages:
            blocks = html.blocks_of(page)
            scores = chain_scores(field, blocks)
            every = np.logaddexp.reduce(list(scores.values()))
            total += scores[truth] - every
            for y, v in [*((y, -np.exp(v - every)) for y, v in scores.items()), (truth, 1.0)]:
                for f, c in zip(html.features(blocks), y):
                    for x in f:
                        gap[index[x], c] += v
                for a, b in zip(y, y[1:]):
                    pairs[a, b] += v
        n = len(pages)
        return total / n - 0.001 * (w @ w), np.concatenate([gap.ravel(), pairs.ravel()]) / n - 0.002 * w

    for w in r.standard_normal((5, 2 * len(index) + 4)):
        (f, g), (f2, g2) = value(w), enumerated(w)
        assert f == pytest.approx(f2, abs=1e-9) and np.abs(g - g2).max() < 1e-9
        d = r.standard_normal(len(w))
        assert (value(w + 1e-6 * d)[0] - value(w - 1e-6 * d)[0]) / 2e-6 == pytest.approx(g @ d, abs=1e-6)
    field = html.fit(pages, tolerance=1e-6)
    assert np.abs(enumerated(np.concatenate([field.weights.ravel(), field.pairs.ravel()]))[1]).max() < 2e-6
    with pytest.raises(RuntimeError, match="not fitted"):
        html.fit(pages, tolerance=1e-12, most_steps=2)


def test_html_nesting_costs_no_more_than_length():
    field = html.fitted()
    for page in ("<div class='a b'>x" * 40_000, "".join(f"<div class='n{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}'>x" for k in range(20_000)), "<form>" * 20_000 + "<li>x</li>" * 20_000, "<div>" * 20_000 + "</p>x" * 20_000):
        tracemalloc.start()
        began = time.perf_counter()
        blocks = html.blocks_of(page)
        field.decode(blocks)
        took, most = time.perf_counter() - began, tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(blocks) >= 20_000 and took < 20 and most < 200e6  # traced, which is some times slower


def other_layouts(r):
    """Pages laid out unlike the training pages: (html, main text)."""
    w = lambda a, b: " ".join("".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(r.randint(a, b)))
    paragraphs = [w(15, 80).capitalize() + r.choice((".", ".", "!", "?")) for _ in range(r.randint(3, 9))]
    title, links = w(3, 8).capitalize(), "".join(f"<a href='/{k}'>{w(1, 2)}</a> | " for k in range(8))
    items = "".join(f"<li><a href='/{k}'>{w(1, 4)}</a></li>" for k in range(6))
    body = "".join(f"<p>{p}</p>\n" for p in paragraphs)
    kind = r.randrange(4)
    if kind == 0:  # tables
        page = f"<html><body><table width=100%><tr><td colspan=2>{links}</td></tr><tr><td width=20%><ul>{items}</ul></td><td><h1>{title}</h1>{body}</td></tr><tr><td colspan=2><small>Copyright © 2020 {w(1, 3)}. <a href=/x>{w(1, 2)}</a></small></td></tr></table></body></html>"
    elif kind == 1:  # semantic elements without names
        page = f"<!doctype html><html><body><header><h2>{w(1, 3)}</h2><nav>{links}</nav></header><main><h1>{title}</h1>{body}</main><aside><h3>{w(1, 3)}</h3><ul>{items}</ul></aside><footer><p>© {w(2, 5)}</p></footer></body></html>"
    elif kind == 2:  # blocks with names only, comments after the text
        page = f"<body><div id=top-nav>{links}</div><div class='main column'><div class=post><h1>{title}</h1>{body}</div><div id=comments><h3>{w(1, 2)}</h3><div class=comment><p>{w(5, 20)}.</p></div><form><label>{w(1, 2)}</label><input></form></div></div><div class=sidebar><div class=widget><ul>{items}</ul></div></div><div id=footer>{links}</div></body>"
    else:  # a notice and adverts amid the article
        half = len(paragraphs) // 2
        body = "".join(f"<p>{p}</p>" for p in paragraphs[:half]) + f"<div class='ad-slot'>{w(3, 8)} <a href=/buy>{w(1, 2)}</a></div>" + "".join(f"<p>{p}</p>" for p in paragraphs[half:])
        page = f"<body><div class=cookie-notice>{w(8, 15)}. <button>{w(1, 1)}</button></div><ul class=menu>{items}</ul><article><h1>{title}</h1>{body}</article><div class=related><ul>{items}</ul></div></body>"
    return page, [title, *paragraphs]


def test_html_accuracy_on_other_layouts():
    r, field = random.Random(26), html.fitted()
    hit = found = wanted = 0
    for _ in range(200):
        page, main = other_layouts(r)
        got = html.main_text(page, field).split("\n")
        hit += (Counter(got) & Counter(main)).total()
        found, wanted = found + len(got), wanted + len(main)
    f1 = 2 * hit / (found + wanted)
    print("block F1 on other layouts", f1)
    assert f1 > 0.95


def test_html_awkward_rows(spark):
    page = "<article><p>" + "long text of many words. " * 40_000 + "</p></article>"
    rows = spark.createDataFrame([(1, "u", page), (1, "u", page), (2, "v", "<p>" * 20_000 + "deep text in here, said so."), (3, None, "<" * 50_000)], "page_id long, url string, html string")
    got = Counter((x["page_id"], x["n_chars"]) for x in html.extract(rows).collect())
    assert got[1, len(("long text of many words. " * 40_000).strip())] == 2 and sum(got.values()) == 4


def test_html_query(spark):
    page = "<html><body><nav><a href='/'>Home</a></nav><article><h1>Title here</h1><p>Some text of the article, with &eacute;nough words.</p></article><footer>&copy; us</footer></body></html>"
    rows = spark.createDataFrame([(1, "u", page, 1), (2, None, None, 2), (3, "v", "", 3), (None, "w", page, 4)], "page_id long, url string, html string, n_chars int")
    got = {r["page_id"]: r for r in html.extract(rows).collect()}
    assert got[1]["text"] == "Title here\nSome text of the article, with énough words." and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == got[3]["text"] == "" and got[None]["text"] == got[1]["text"]
    assert html.extract(rows.where("false")).count() == 0


def test_lcs():
    import numpy as np

    r = random.Random(6)
    for _ in range(100):
        a, b = ([r.randint(0, 5) for _ in range(r.randint(1, 15))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert latent.lcs(len(a), latent.places(np.array(a)), b) == table[-1][-1]


def test_decontamination_recall(spark, texts):
    r = random.Random(8)
    vocabulary = ["".join(r.choice("mnopqrst") for _ in range(r.randint(2, 7))) for _ in range(600)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randint(12, 50)))) for k in range(30)] + [(99, None), (98, " . ")]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    docs, leaks = list(texts), set()
    for k in range(30):
        w = items[k][1].split()
        for j in range(0, len(w), 9):
            w[j] = w[j].upper() if k % 2 else "other"  # every ninth word changed
        filler = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
        docs.append((1000 + k, f"{filler(r.randint(0, 150))} {' '.join(w)} {filler(r.randint(0, 150))}"))
        leaks.add((1000 + k, k))
        docs.append((2000 + k, filler(200)))
    got = latent.contaminated(frame(spark, docs), benchmark)
    found = {(x["doc_id"], x["item_id"]) for x in got.collect()}
    assert len(found & leaks) >= 0.9 * len(leaks) and found <= leaks
    kept = {x["doc_id"] for x in latent.drop_contaminated(frame(spark, docs), benchmark).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in found}
    assert latent.contaminated(frame(spark, docs), benchmark.where("false")).count() == 0
    assert latent.contaminated(frame(spark, []), benchmark).count() == 0


def test_decontamination_against_brute_force(spark):
    r = random.Random(14)
    vocabulary = ["".join(r.choice("mnopqrst") for _ in range(r.randint(2, 7))) for _ in range(500)]
    filler = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(k, filler(r.choice((5, 7, 10, 12, 25)))) for k in range(300)]  # more than the space has dimensions
    docs, leaks = [], set()
    for k, (item, text) in enumerate(items):
        docs.append((k, f"{filler(r.randint(40, 120))} {text} {filler(r.randint(40, 120))}"))
        leaks.add((k, item))
        docs.append((1000 + k, f"{filler(80)} {items[0][1] if k % 2 else filler(5)} {filler(80)}"))  # one item in a third of the documents
        leaks.update({(1000 + k, 0)} if k % 2 else ())
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    found = {(x["doc_id"], x["item_id"]) for x in latent.contaminated(frame(spark, docs), benchmark).collect()}
    assert leaks <= found
    checks = [latent.Item(*i) for i in items]
    expected = set()
    for i, t in docs:
        words_ = latent.terms_of(t)
        there = set(words_.tolist())
        for item in checks:
            n = len(item.words)
            if sum(x in there for x in item.words.tolist()) >= 0.7 * n and any(latent.leaked(*item.check(words_[s : s + 2 * n])) for s in range(len(words_))):
                expected.add((i, item.item_id))
    assert expected <= found and len(found) <= 1.02 * len(expected)
    without = {(x["doc_id"], x["item_id"]) for x in latent.contaminated(frame(spark, docs), benchmark, floor=2.0).collect()}
    assert without == expected


def test_decontamination_of_short_items(spark):
    # items of three or four words have no keys: the cosine alone finds them, each among 200 other words
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 6))
    items = [(k, " ".join(word() for _ in range(3 + k % 2))) for k in range(100)]
    common_words = [word() for _ in range(500)]
    docs = []
    for k, text in items:
        rest = list(rng.choice(common_words, 200))
        at = int(rng.integers(0, 201))
        docs.append((k, " ".join([*rest[:at], text, *rest[at:]])))
    docs += [(1_000 + k, " ".join(rng.choice(common_words, 200))) for k in range(100)]
    out = latent.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r["doc_id"], r["item_id"]) for r in out}
    assert len(found & {(k, k) for k in range(100)}) >= 95
    assert all(a == b for a, b in found)


def test_decontamination_awkward_rows(spark):
    r = random.Random(23)
    filler = lambda n: " ".join(f"w{r.randint(0, 5000)}" for _ in range(n))
    item, long = filler(20), filler(60_000)
    items = spark.createDataFrame([(None, item), (-1, filler(15)), (3, item), (3, item), (4, ""), (5, filler(4_000))], "item_id long, text string")
    docs = [(1, long + " " + item + " " + long), (2, None), (3, ""), (None, item), (4, item), (4, item), (4, "other"), (5, filler(500))]
    got = Counter((x["doc_id"], x["item_id"]) for x in latent.contaminated(frame(spark, docs), items).collect())
    assert got == Counter({(1, None): 1, (1, 3): 1, (None, None): 1, (None, 3): 1, (4, None): 2, (4, 3): 2})
    left = latent.drop_contaminated(frame(spark, docs), items).collect()
    assert Counter(x["doc_id"] for x in left) == Counter([2, 3, None, 5]) and {x["_gone"] for x in left} == {"g"}
    counts = latent.document_counts(frame(spark, docs).select("text"), np.unique(latent.terms_of(item + " absent")))
    assert sorted(set(counts.tolist())) == [0, 4] or counts.sum() >= 4 * len(set(item.split()))


def test_decontamination_in_several_passes(spark, monkeypatch):
    r = random.Random(24)
    items = [(k, " ".join(f"v{r.randint(0, 900)}" for _ in range(15))) for k in range(12)]
    docs = [(k, "some words before " + t + " and some after") for k, t in items]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    key = lambda df: sorted((x["doc_id"], x["item_id"], x["lcs"]) for x in df.collect())
    whole = key(latent.contaminated(frame(spark, docs), benchmark))
    monkeypatch.setattr(latent, "CHARS_AT_ONCE", 300)
    assert key(latent.contaminated(frame(spark, docs), benchmark)) == whole and len(whole) == 12


def test_pipeline_stages_on_awkward_rows(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(27)
    made = lambda n: " ".join(f"w{r.randint(0, 3000)}" for _ in range(n))
    item, long, block = made(20), made(30_000), "\n".join(made(8) for _ in range(3))
    texts = [made(60) for _ in range(20)]
    rows = [(k, t, 1, "x") for k, t in enumerate(texts)] + [(1, texts[1], 1, "x")] * 3 + [(30, texts[2], 1, "x"), (31, None, 1, "x"), (32, "", 1, "x"), (33, long, 1, "x"), (34, f"own {made(40)}\n{block}", 1, "x"), (35, f"next {made(40)}\n{block}", 1, "x"), (36, f"{made(30)} {item} {made(30)}", 1, "x"), (None, texts[3], 1, "x"), (None, texts[3], 1, "x"), (None, None, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ratios int, `row` string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long"), "_id": F.lit(5), "_gone": F.lit(6)})
    spark.createDataFrame([(k, 1, 0) for k in range(40)] + [(None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    ids = lambda df: Counter(x["doc_id"] for x in df.select("doc_id").collect())
    base = Counter({k: 1 for k in [*range(20), 30, 33, 34, 35, 36]}) + Counter({1: 3, None: 2})
    empty = Counter([31, 32, None])
    expected = {
        "quality_rules": base, "line_dedup": base + empty - Counter([30]), "near_dedup": base + empty - Counter([30, 32]),
        "decontamination": base + empty - Counter([36]), "best_fit_packing": base,
    }
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        got = ids(out)
        assert (got if name != "best_fit_packing" else Counter({k: min(v, base[k]) for k, v in got.items()})) == expected[name], name
        if name != "best_fit_packing":
            assert tuple(out.columns) == corpus_pipeline.COLUMNS
        if name == "line_dedup":
            kept = {x["doc_id"]: x for x in out.where("doc_id in (34, 35)").collect()}
            assert block in kept[34]["text"] and kept[35]["text"].startswith("next ") and "\n" not in kept[35]["text"] and kept[35]["n_chars"] == len(kept[35]["text"])
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0


def test_pipeline_leaves_no_folders_of_its_stages(spark, tmp_path):
    from tramline.llm.common import removed, settled, written

    made = []
    out, path = settled(lambda: made.append(written(spark.range(9))) or made[0].where("id > 3"))
    assert out.count() == 5
    with pytest.raises(Exception, match="(?i)not exist|no such|not_found"):
        made[0].count()
    removed(spark, path)


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(9)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(80)]
    made = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    rows = [(k, made(60), "en", "s", 0) for k in range(40)]
    rows += [(100, rows[1][1], "en", "s", 0), (101, None, "en", None, None), (102, "", "en", "s", 0), (None, made(50), None, "s", 0)]
    rows.append((103, made(30) + " " + (item := made(25)) + " " + made(30), "en", "s", 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x["doc_id"] for x in out} == {*range(40), None}
