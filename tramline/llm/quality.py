"""Quality rules and a hashed n-gram log-likelihood ratio, in built-in
functions only.

Every document gives hashed features: its words, pairs of neighbouring words
and the last three characters of each word. Two multinomials over the hash
buckets are estimated on all documents: one of the trusted target (documents
labelled as good and not toxic), one of the raw corpus. A document's verdict is
the mean log ratio over its features against a fixed threshold. The model is
one number for each bucket, so its size is set by a parameter, not by the data;
the counting aggregates partially before its shuffle, over the buckets. Texts are
not shuffled: the ids of the target are sent to the texts where they are few
enough (a checked size), beyond that only texts with such ids could meet them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words, written

BUCKETS = 16_384
#: Documents whose mean log ratio is below this are rejected.
THRESHOLD = -0.25
WINDOW = 8
#: Trusted ids that are broadcast at most; a hash table of so many takes some 32 MB.
BROADCAST_IDS = 1_000_000


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body's own
    lambdas refer to it (an expression there is computed for each element)."""
    return F.transform(F.array(value), body)[0]


def repeated_words(w: Column, size: int = WINDOW) -> Column:
    """How many words lie in windows of ``size`` words found twice or more in
    the text, the first included. Linear but for a sort, and that only in texts
    that have such windows."""

    def covered(h: Column) -> Column:
        def at(s: Column) -> Column:
            same = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False)))
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        start = F.struct(F.lit(-size).alias("last"), F.lit(0).alias("total"))
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        step = lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(size), p - a["last"])).alias("total"))
        return F.aggregate(let(pairs, at), start, step, lambda a: a["total"])

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.xxhash64(F.slice(w, i, size)))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))

    return let(w, lambda w: F.when(F.size(w) < size, F.lit(0)).otherwise(counted(w))).cast("long")


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, w, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed) of each row; ``w`` are the words."""
    text = F.coalesce(F.col("_t"), F.lit(""))
    symbols = "#*$%&|<>"
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, " \t\x0b\x0c\r", "") != "")
    out = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("_t")).withColumn("w", words(F.col("_t")))
    out = out.select(
        id_col,
        "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, symbols, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
    )
    return out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def bucket(*x: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*x), F.lit(buckets)).cast("int")


def of_word(word: Column, following: Column, buckets: int = BUCKETS) -> Column:
    """The features that a word and the word after it give, as buckets."""
    end = bucket(F.right(word, F.lit(3)), F.lit(3), buckets=buckets)
    return F.array(bucket(word, buckets=buckets), bucket(word, following, buckets=buckets), end)


def word_rows(rows: DataFrame, *keep: str) -> DataFrame:
    """A row for each word of ``w``: the ``keep`` columns, word, following.

    Exploding first leaves the hashing to generated code, which is several
    times faster than lambdas over arrays.
    """
    following = F.concat(F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), F.array(F.lit("")))
    pairs = rows.select(*keep, F.explode(F.arrays_zip(F.col("w").alias("word"), following.alias("following"))).alias("p"))
    return pairs.select(*keep, "p.word", "p.following")


def model(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, smoothing: float = 4.0, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """One row, one column: the log ratio target / raw of every bucket.

    ``trusted`` holds the ids of the target's documents. Without any, all
    ratios are zero. Both ways to mark the target count the same.
    """
    ids = trusted.select(F.col(id_col).cast("long").alias("_id")).where("_id is not null").distinct()
    ids = written(ids.withColumn("_good", F.lit(1)))
    text = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_t"))
    if ids.count() <= broadcast_ids:
        marked = text.join(F.broadcast(ids), "_id", "left")
    else:  # rows without an id are nobody's; a second key keeps them apart in the shuffle
        spread = F.when(F.col("_id").isNull(), F.xxhash64("_t")).otherwise(F.lit(0))
        marked = text.withColumn("_spread", spread).join(ids.withColumn("_spread", F.lit(0).cast("long")).hint("merge"), ["_id", "_spread"], "left")
    marked = marked.select(F.coalesce("_good", F.lit(0)).alias("good"), words(F.col("_t")).alias("w"))
    pairs = word_rows(marked.where(F.size("w") > 0), "good")
    grams = pairs.select("good", F.explode(of_word(F.col("word"), F.col("following"), buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("target"))
    counts = written(counts)
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).head()
    # smoothing in proportion to each side's size: a bucket with the same share in both has ratio 0, however few there are
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    scaled = count("target") * (total["raw"] / total["target"]) if total["target"] else count("raw")
    ratio = F.log((scaled + smoothing) / (count("raw") + smoothing)).cast("double")
    every = docs.sparkSession.range(0, buckets, 1, 1).select(F.col("id").cast("int").alias("bucket"))
    each = every.join(counts, "bucket", "left").select(F.struct("bucket", ratio.alias("ratio")).alias("x"))
    return written(each.agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["ratio"]).alias("ratios")))


def mean_ratio(w: Column, ratios: Column, buckets: int = BUCKETS) -> Column:
    """The mean log ratio of the features of the words ``w``; 0 without words.

    By lambdas, since a text has to stay with its row. Words and ratios are to
    be bound outside (``let``, a column), and each word's features are summed
    as they come, word by word, so a score does not depend on the plan.
    """

    def of(x: Column) -> Column:
        w, r = x["w"], x["r"]
        ratio = lambda *h: F.get(r, bucket(*h, buckets=buckets))
        each = F.transform(w, lambda word, i: ratio(word) + ratio(word, F.coalesce(F.get(w, i + 1), F.lit(""))) + ratio(F.right(word, F.lit(3)), F.lit(3)))
        return F.when(F.size(w) == 0, F.lit(0.0)).otherwise(F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / (3 * F.size(w)))

    return let(F.struct(w.alias("w"), ratios.alias("r")), of)


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: (id_col, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, score, kept).

    ``score`` is the mean log ratio of the document's features (0 without
    words), ``kept`` is false if a base rule fails or the score is below the
    threshold; a score at the threshold is kept. Null and empty texts have no
    words and fail the base rules; a null id is judged like any other but is
    never trusted; repeated rows each give a row and count each time; texts are
    scored whole, whatever their length; an empty table gives no rows; other
    columns are not read.
    """
    ratios = model(docs, trusted, id_col, text_col, buckets).select("ratios").scalar()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    scored = base_counts(docs, id_col, text_col).withColumn("r", ratios).select(id_col, *counts, mean_ratio(F.col("w"), F.col("r"), buckets).alias("score"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled as of good quality and not toxic."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")


def drop_rejected(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns unchanged, of
    whatever names; its cases hold here too. The verdict is computed on the row
    itself, so no join follows.
    """
    ratios = model(docs, trusted, id_col, text_col).select("ratios").scalar()

    def good(x: Column) -> Column:
        n = F.size(x["w"])
        return (n >= 20) & (100 * repeated_words(x["w"]) <= 30 * n) & (mean_ratio(x["w"], x["r"]) >= threshold)

    # the ratios ride in a struct beside the row's own, so no name can clash
    both = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), ratios.alias("ratios"))
    bound = F.struct(words(F.col(f"row.`{text_col}`")).alias("w"), F.col("ratios").alias("r"))
    return both.where(let(bound, good)).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
