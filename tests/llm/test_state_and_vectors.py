"""Streaming deduplication, whitening and hard negatives against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramline.llm import common, exact, latent, negatives, substrings, whitening
from tramline.llm.vectors import whole_vectors

BLANK = str.maketrans("", "", " \t\n\x0b\x0c\r")
DOCS = "text string, doc_id long, digest binary, n long, file string, `_gone` string"


def saved(spark, folder, rows):
    full = [(t, i, b"x", 1, "f", "g") for i, t in rows]
    spark.createDataFrame(full, DOCS).coalesce(1).write.mode("append").parquet(str(folder))


def judged(rows):
    """(id, keep id, size, sha) of each row, by comparing texts."""
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(BLANK), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        bare = (t or "").translate(BLANK)
        out.append((i, min(groups[bare], key=lambda g: (g[0], g[1], g[2] or 0))[2], len(groups[bare]), hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=repr)


def awkward_texts():
    r = random.Random(3)
    rows = [(k, "".join(r.choice("ab \n\té") for _ in range(r.randint(0, 4)))) for k in range(150)]
    rows += [(None, "a b"), (None, None), (500, None), (501, ""), (502, " \x0b\x0c\r"), (503, " "), (7, "q"), (7, "q"), (8, "q"), (None, "only"), (None, "only")]
    return [*rows, (600, "x" * 200_000), (601, " " + "x" * 200_000), (602, "x" * 199_999)]


def rows_of(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("digest", [exact.sha256, lambda t: F.substring(F.unhex(F.sha2(t, 256)), 1, 1), lambda t: F.encode(F.lit("same"), "utf-8")])
def test_exact_against_brute_force(spark, tmp_path, digest):
    # with a digest of one byte, or none at all, texts share digests and are told apart by their bytes
    rows = awkward_texts()
    for k in range(3):
        saved(spark, tmp_path / "docs", rows[k::3])
    got = exact.dedup(spark, str(tmp_path / "docs"), digest=digest, maxFilesPerTrigger="1")
    assert rows_of(got) == judged(rows)
    kept = got.where("kept").groupBy("text_sha256").count().collect()
    assert {r["count"] for r in kept} == {1} and len(kept) == len({r[3] for r in judged(rows)})
    assert got.where("kept and not doc_id <=> keep_id").count() == 0


def test_exact_goes_on_from_its_state(spark, tmp_path):
    docs, folder = tmp_path / "docs", str(tmp_path / "work")
    first, more = [(5, "a b"), (6, "c")], [(4, "ab"), (3, "a  b"), (9, "c"), (2, "d")]
    seen = []
    for rows in (first, more):
        saved(spark, docs, rows)
        seen += rows
        exact.start(exact.stream(spark, str(docs)), folder).awaitTermination()
        state = {r["digest"].hex(): (r["n"], ~r["keeper"]["rank"]) for r in exact.groups(spark, folder).collect()}
        assert state == {sha: (n, keep) for _, keep, n, sha in judged(seen)}
    assert rows_of(exact.resolved(spark.read.parquet(str(docs)), exact.groups(spark, folder))) == judged(seen)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_exact_empty(spark, tmp_path):
    saved(spark, tmp_path / "docs", [])
    assert exact.dedup(spark, str(tmp_path / "docs")).collect() == []


VECTORS = "x array<long>, embedding array<float>, vec_id long, label int, n long, `_anchor` string"


def vectors(spark, rows, partitions=3):
    return spark.createDataFrame([([1], v, i, y, 3, "s") for i, v, y in rows], VECTORS).repartition(partitions)


AWKWARD = [(900, None, 1), (901, [], 1), (902, [1.0, None, 2.0], 2), (903, [math.nan, 0.0, 0.0], 1), (904, [math.inf, 0.0, 0.0], 1), (905, [1.0], 1)]


def test_whole_vectors(spark):
    rows = [(1, [0.5, -0.001, 0.0], 1), (None, [-0.0, 1.0, 2.0], None), *AWKWARD]
    got = sorted(((r["vec_id"], r["x"]) for r in whole_vectors(vectors(spark, rows), "embedding", "vec_id").collect()), key=repr)
    assert got == [(1, [128, -1, 0]), (None, [0, 256, 512])]


def fitted(rows):
    """Of distinct whole vectors: n, sums, eigenvalues and eigenvectors by numpy."""
    x = {tuple(math.floor(256 * float(np.float32(c))) for c in v) for _, v, _ in rows}
    x = np.array(sorted(x), float)
    values, found = np.linalg.eigh(np.cov(x.T, bias=True))
    return len(x), x.sum(axis=0), values[::-1], found[:, ::-1], x


@pytest.mark.parametrize(("n", "d", "block"), [(400, 3, 64), (300, 40, 4), (900, 150, 8)])
def test_whitening_against_numpy(spark, n, d, block):
    r = np.random.default_rng(d)
    x = r.standard_normal((n, d)) * (1 + np.arange(d) % 7) * 0.1 + 1
    rows = [(k, v, 1) for k, v in enumerate(x.tolist())]
    rows += [(None, rows[3][1], 1), (5, rows[5][1], 1), *((1000 + k, rows[7][1], 2) for k in range(30))]
    wrong = [(i, None if v is None else (v * d)[:d] if len(v) == 3 else v, y) for i, v, y in AWKWARD]
    size, sums, values, found, _ = fitted(rows)
    out, model = whitening.whiten(vectors(spark, rows + wrong), 4, block=block)
    k = min(4, d)
    assert model.n == size and model.sums == sums.astype(int).tolist() and model.residual <= 1e-12
    assert np.allclose(model.values, values[:k], rtol=1e-10) and np.isclose(model.trace, values.sum())
    assert np.allclose(np.abs(np.diag(model.components.T @ found[:, :k])), 1, atol=1e-9)
    assert model.identity_error < 1e-9 and (model.passes > 1) == (block < d)
    got = out.collect()
    assert len(got) == len(rows)
    turned = np.sign(np.diag(model.components.T @ found[:, :k]))
    by_id = {i: np.floor(256 * np.array(v, np.float32).astype(float)) for i, v, _ in rows}
    for g in got:
        v = by_id[g["vec_id"]]
        assert np.allclose(g["whitened"], turned * ((v - sums / size) @ found[:, :k]) / np.sqrt(values[:k]), atol=1e-7)
        assert int(g["deviation"]) == sum((size * int(a) - int(b)) ** 2 for a, b in zip(v, sums, strict=True))


def test_whitening_awkward(spark):
    empty = whitening.report(vectors(spark, []))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.report(vectors(spark, [(1, [1.0, 2.0], 1)] * 3)).collect() == []  # one vector has no variance
    flat = whitening.report(vectors(spark, [(k, [float(k), 2.0 * k, 3.0], 1) for k in range(9)])).collect()
    assert {r["component"] for r in flat} == {1} and math.isclose(flat[0]["explained"], 1) and len(flat) == 9
    large = whitening.report(vectors(spark, [(1, [1e12, 0.0], 1), (2, [-1e12, 5.0], 1)])).collect()
    assert len(large) == 2 and all(r["deviation"] is None for r in large)


def mined(rows, anchors, positives, count):
    """All (anchor, positive, rank, negative, scores), by comparing with every row."""
    whole = {}
    for i, v, y in rows:
        if i is not None and y is not None and v and len(v) == 3 and all(c is not None and math.isfinite(c) for c in v):
            x = tuple(math.floor(256 * float(np.float32(c))) for c in v)
            whole[i] = min(whole.get(i, (y, x)), (y, x))
    out = []
    for a in (i for i in whole if anchors(i)):
        y, x = whole[a]
        score = {i: sum(p * q for p, q in zip(x, other, strict=True)) for i, (_, other) in whole.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if whole[i][0] == y][:positives]:
            fit = [i for i in order if whole[i][0] != y and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, k, i, score[p], score[i]) for k, i in enumerate(fit[:count], 1)]
    return sorted(out)


@pytest.mark.parametrize(("block_rows", "waves"), [(256, (8, 64)), (5, (1, 2, 4)), (20, ())])
def test_negatives_against_brute_force(spark, monkeypatch, block_rows, waves):
    monkeypatch.setattr(negatives.search, "__defaults__", (waves,))
    r = np.random.default_rng(block_rows)
    centres = r.standard_normal((6, 3))
    rows = [(k, (centres[k % 6] + 0.3 * r.standard_normal(3)).tolist(), int(r.integers(0, 3))) for k in range(400)]
    rows += [(1000 + k, rows[12][1], k % 4) for k in range(150)]  # copies: ties of every score
    rows += [(2000, rows[5][1], None), (None, rows[5][1], 1), (20, rows[20][1], rows[20][2]), (30, rows[31][1], 9), (3000, [0.0, 0.0, 0.0], 1), *AWKWARD]
    got = negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0, block_rows=block_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == mined(rows, lambda i: i % 10 == 0, 5, 10)


def test_negatives_awkward(spark):
    anchor = F.col("vec_id") % 10 == 0
    assert negatives.mine(vectors(spark, []), anchor).collect() == []
    assert negatives.mine(vectors(spark, AWKWARD[:2]), anchor).collect() == []
    assert negatives.mine(vectors(spark, [(10, [1.0, 1.0, 1.0], 1), (11, [1.0, 1.0, 1.0], 2)]), anchor).collect() == []  # no positive
    scaled = [(10, [4e6, 0.0, 0.0], 1), (11, [4e6, 0.0, 0.0], 1), (12, [2e6, 0.0, 0.0], 2)]
    got = negatives.mine(vectors(spark, scaled), anchor).collect()
    assert [tuple(r) for r in got] == mined(scaled, lambda i: i == 10, 5, 10) != []


# --- hot keys, long items ------------------------------------------------------------


def test_split_join_where_the_list_of_heavy_keys_is_long(spark, monkeypatch):
    monkeypatch.setattr(common, "HEAVY_KEYS", 3)
    monkeypatch.setattr(common, "TASK_ROWS", 10)
    many = spark.range(600).select((F.col("id") % 20).alias("k"), F.col("id").alias("v"))
    one = spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 7).alias("w"))
    joined = common.split_join(many, one, "k", many.groupBy("k").agg(F.count("*").alias("n")), F.col("v"))
    assert sorted(map(tuple, joined.select("v", "k", "w").collect())) == [(v, v % 20, v % 20 * 7) for v in range(600)]


@pytest.mark.parametrize("repeated_id", [None, 5])
def test_substrings_deal_repeated_rows(spark, repeated_id):
    # a third of all rows repeat one id and text that would fill many bundles
    r = random.Random(8)
    text = lambda n: " ".join(f"w{r.randint(0, 400)}" for _ in range(n))
    rows = [(k, text(60)) for k in range(10, 110)]
    hot = rows[3][1] + " " + text(80)
    rows += [(repeated_id, hot)] * 60 + [(3, text(10) + " " + hot[:200])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    run = lambda: {(x["doc_id"], x["n_words"], x["n_removed"], x["kept_sha256"]) for x in substrings.dedup_substrings(docs, bundle_chars=3_000).collect()}
    got = substrings.dedup_substrings(docs, bundle_chars=3_000).collect()
    assert len(got) == len(rows)
    order = lambda i: float("inf") if i is None else i
    first = {}
    windows = lambda t: [tuple(t.split()[k : k + 13]) for k in range(len(t.split()) - 12)]
    for i, t in rows:
        for w in windows(t):
            first[w] = min(first.get(w, float("inf")), order(i))
    expected = []
    for i, t in rows:
        gone = {p for k, w in enumerate(windows(t)) if first[w] < order(i) for p in range(k, k + 13)}
        kept = " ".join(w for p, w in enumerate(t.split()) if p not in gone)
        expected.append((i, len(t.split()), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    alike = docs.groupBy("doc_id", F.xxhash64("text").alias("_h")).agg(F.sum(F.length("text")).alias("_chars")).where("_chars > 3000")
    dealt = substrings.apart(docs, alike, "doc_id", 3_000)
    sizes = [x["count"] for x in dealt.where(F.col("doc_id").eqNullSafe(F.lit(repeated_id))).groupBy("_salt").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 15 and run() == run()


def test_the_best_stretch_of_long_items():
    r = random.Random(2)
    word = lambda n: [f"v{r.randint(0, n)}" for _ in range(200)]
    for trial in range(40):
        words = [f"i{r.randint(0, 30)}" for _ in range(r.randint(5, 25))]
        item = latent.Item(1, " ".join(words))
        text = word(50)
        for _ in range(r.randint(1, 3)):
            copy = [w for w in words if r.random() < r.choice((1, 0.9, 0.8))]
            at = r.randint(0, 150)
            text[at : at + len(copy)] = copy
        hashes = latent.terms_of(" ".join(text))
        size = latent.STRETCH * len(item.words)
        first, end, best = r.randint(0, 20), r.randint(100, 200), None
        for x in range(first, end):
            if int(hashes[x]) in item.where:
                share, answer = item.check(hashes[x : min(x + size, 200)])
                if latent.leaked(share, answer) and (best is None or (share, answer) > best[1:]):
                    best = (x, share, answer)
        assert latent.best_stretch(item, hashes, first, end, 200, size) == best, trial
    words = [f"w{r.randint(0, 10**6)}" for _ in range(3_000)]
    item = latent.Item(1, " ".join(words))
    hashes = latent.terms_of(" ".join([*word(50), *words, *word(50), *words]))
    began = time.perf_counter()
    assert latent.best_stretch(item, hashes, 0, len(hashes), len(hashes), latent.STRETCH * 3_000)[1] == 1
    assert time.perf_counter() - began < 3
