"""Substring dedup, the n-gram join, components, nearest neighbours and the pipeline."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strataforge.llm import ivfpq, ngram_join, repeats, shared, skew, substring_dedup
from strataforge.llm.components import components

W = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, block string, id int"


def corpus(seed, n=60, vocabulary=60):
    """Random texts with copies, near copies, shared passages, repeats and odd rows."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(vocabulary)}{r.choice(['', '.', 'É'])}"
    passage = [word() for _ in range(50)]
    out = []
    for _ in range(n):
        kind, words = r.randrange(7), [word() for _ in range(r.randrange(1, 150))]
        if kind == 0 and out:
            words = W.findall(r.choice(out) or "x")
        elif kind == 1 and out:
            words = W.findall(r.choice(out) or "x")
            for _ in range(r.randrange(1, 5)):
                words[r.randrange(len(words))] = word()
        elif kind == 2:
            at = r.randrange(len(words))
            words[at:at] = passage
        elif kind == 3:
            words = words[:20] * 6
        out.append(r.choice([" ", "\n", "\t "]).join(words))
    return [*out, None, "", " \n", "a b", "A B", "a b c", "one", passage[0] + " " * 50, out[0], out[0].upper()]


def table(spark, texts):
    return spark.createDataFrame([(i, t, "clash", 7) for i, t in enumerate(texts)], SCHEMA)


def removed_by_hand(texts, width):
    words = [W.findall(t or "") for t in texts]
    n = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - width + 1) if n[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize(("seed", "width"), [(1, 35), (2, 5)])
def test_substring_dedup(spark, seed, width):
    texts = corpus(seed)
    df = table(spark, texts).repartition(3)
    want = removed_by_hand(texts, width)
    got = {r.doc_id: r for r in substring_dedup.repeated_spans(df, width).collect()}
    for i, (n, gone, kept) in enumerate(want):
        r = got[i]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
        assert sum(s.stop - s.start for s in r.removed) == gone
        assert all(a.stop < b.start for a, b in zip(r.removed, r.removed[1:], strict=False))  # maximal
    cut = substring_dedup.remove_repeats(df, width, length_col=None)
    assert cut.columns == df.columns
    for r in cut.collect():
        n, gone, kept = want[r.doc_id]
        assert r.text == (kept if gone else texts[r.doc_id]) and r.block == "clash"


def test_substring_dedup_of_nothing_and_of_one_hot_passage(spark):
    assert substring_dedup.repeated_spans(table(spark, []).limit(0)).count() == 0
    hot = " ".join(f"h{i}" for i in range(40))
    texts = [f"{i} {hot} {i}" for i in range(3000)]
    got = substring_dedup.repeated_spans(table(spark, texts)).groupBy("n_words", "n_removed").count().collect()
    assert [tuple(r) for r in got] == [(42, 40, 3000)]


def shingle_sets(texts):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for t in texts:
        w = W.findall((t or "").translate(fold))
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []))
    return out


def classes_by_hand(texts):
    sets = shingle_sets(texts)
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(range(len(sets)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("seed", [1, 2])
def test_similarity_classes(spark, seed):
    texts = corpus(seed, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_classes(table(spark, texts)).collect()}
    assert got == dict(enumerate(classes_by_hand(texts)))


def test_large_group_of_near_copies(spark):
    r = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for i in range(250):
        words = list(base)
        for k in range(r.randrange(0, 4)):
            words[r.randrange(60)] = f"x{i}_{k}"
        texts.append(" ".join(words))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_classes(table(spark, texts)).collect()}
    assert got == dict(enumerate(classes_by_hand(texts)))


def test_links_survive_without_star_rounds_and_in_small_parts(spark, monkeypatch):
    texts = corpus(9, 60)
    want = dict(enumerate(classes_by_hand(texts)))
    for name, value in (("STAR_ROUNDS", 0), ("TILE", 3)):
        monkeypatch.setattr(ngram_join, name, value)
    monkeypatch.setattr(skew, "LEAST", 5)
    monkeypatch.setattr(repeats, "FAN", 3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_classes(table(spark, texts)).collect()}
    assert got == want
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", 3)
    monkeypatch.setattr(ngram_join, "STAR", 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_classes(table(spark, texts)).collect()}
    assert got == want


def mirrored(steps):
    """Two words of the same length that every polynomial hash modulo 2^64 confuses from ten steps on."""
    out = []
    for a, b in ("ab", "ba"):
        word = a
        for _ in range(steps):
            word += word.translate(str.maketrans(a + b, b + a))
        out.append(word)
    return out


def test_words_that_simple_hashes_confuse(spark):
    tail = [f"t{i}" for i in range(34)]
    texts = [t for k in (9, 10, 11, 12) for w in mirrored(k) for t in (w, " ".join([w, *tail[: 20 + k], *["z"] * (14 - k)]))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_classes(table(spark, texts)).collect()}
    assert got == dict(enumerate(classes_by_hand(texts))) and all(got[i][1] == i for i in range(0, len(texts), 2))
    got = {r.doc_id: r.n_removed for r in substring_dedup.repeated_spans(table(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [gone for _, gone, _ in removed_by_hand(texts, 35)] == [0] * len(texts)


def test_repeats_are_found_over_levels_of_blocks(spark, monkeypatch):
    texts = corpus(11, 70)
    want = {i: (gone, hashlib.sha256(kept.encode()).hexdigest()) for i, (_, gone, kept) in enumerate(removed_by_hand(texts, 35))}
    monkeypatch.setattr(repeats, "FAN", 2)
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_spans(table(spark, texts).repartition(3), 35).collect()}
    assert got == want


def test_one_row_repeated_many_times(spark):
    one = " ".join(f"r{i}" for i in range(60))
    df = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(one).alias("text")).repartition(8)
    assert [tuple(r) for r in substring_dedup.repeated_spans(df).groupBy("doc_id", "n_words", "n_removed").count().collect()] == [(7, 60, 60, 20_000)]
    assert [tuple(r) for r in ngram_join.similarity_classes(df).groupBy("doc_id", "n_shingles", "component_id").count().collect()] == [(7, 56, 7, 20_000)]
    assert ngram_join.keep_one(df).count() == 1


def test_one_of_each_group_stays(spark):
    texts = corpus(4, 40)
    df = table(spark, texts)
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c if n else i for i, (n, c) in enumerate(classes_by_hand(texts))})
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "q r s"), (1, "q r s"), (1, "other"), (2, "q r s")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in ngram_join.keep_one(odd).collect()) == [(0, "a b"), (0, "a b"), (1, "other"), (1, "q r s")]
    assert ngram_join.similarity_classes(df.limit(0)).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 301), (301, 302), (302, 300), (7, 7), (301, 300)]
    with shared.Scratch(spark) as scratch:
        got = dict(components(spark.createDataFrame(edges, "a long, b long"), scratch).collect())
        none = components(spark.createDataFrame([], "a long, b long"), scratch).count()
    want = {i: 0 for i in range(51)} | {100 + i: 100 for i in range(40)} | {300: 300, 301: 300, 302: 300}
    assert got == want
    assert none == 0 and not scratch.held


def test_heavy_keys_join_as_others_do(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST", 10)
    left = spark.createDataFrame([(k, i) for i in range(200) for k in ("hot" if i % 3 else f"k{i % 20}",)], "k string, i int")
    right = spark.createDataFrame([(f"k{i}", i) for i in range(0, 20, 2)] + [("hot", 99)], "k string, v int")
    assert {r.k for r in skew.heavy_keys(left, "k").collect()} == {"hot"}
    for how in ("inner", "left"):
        assert sorted(map(str, skew.attached(left, right, "k", how).collect())) == sorted(map(str, left.join(right, "k", how).collect()))


def test_packed_values_and_hashes():
    rng = np.random.default_rng(1)
    for values in (np.zeros(0, np.uint64), np.array([0], np.uint64), np.array([5, 2**64 - 1], np.uint64), np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64)), np.arange(9, dtype=np.uint64)):
        assert (shared.unpack_sorted(shared.pack_sorted(values)) == values).all()
        assert (shared.distinct(np.concatenate((values, values))) == values).all()
    raw, off = shared.arrow_bytes(pa.chunked_array([pa.array(["ab cd", None, "", "ef"]), pa.array(["gh\u2003i", "cd"])]))
    words = shared.Words(raw, off)
    assert words.first.tolist() == [0, 2, 2, 2, 3, 4, 5]
    h = words.hashes(5)
    assert h[1] == h[4] and len(set(h.tolist())) == 4 and not set(h.tolist()) & set(words.hashes(7).tolist())
    assert repeats.member(np.array([1, 5], np.uint64), np.array([5, 9], np.uint64)).tolist() == [False, True]


def test_window_hashes_by_hand():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 2**63, 90).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    first = np.array([0, 40, 42, 42, 90])
    value = lambda s, base: sum(int(w) % shared.PRIME * pow(base, j, shared.PRIME) for j, w in enumerate(words[s : s + 7].tolist())) % shared.PRIME
    for base in shared.fresh_seeds(2):
        got, starts = shared.window_hashes(words, first, 7, base, piece=16)
        assert starts.tolist() == [*range(34), *range(42, 84)] and got.tolist() == [value(s, base) for s in starts.tolist()]


# --- nearest neighbours


def nearest_by_hand(ids, x, q, top):
    scores = [(-(x[k].astype(float) * x[q].astype(float)).sum(), ids[k]) for k in range(len(ids)) if ids[k] != ids[q]]
    return [i for _, i in sorted(scores)[:top]]


VECTORS = "vec_id long, embedding array<float>, label int, id string"


def vectors(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in row] if row is not None else None, 0, "c") for i, row in zip(ids, x, strict=True)], VECTORS)


@pytest.mark.parametrize(("n", "dim"), [(3_000, 16), (50_000, 32)])
def test_recall_and_exact_scores(spark, monkeypatch, n, dim):
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(n, dim)) * rng.uniform(0.5, 2, size=(n, 1))).astype(np.float32)
    x[: n // 10] = x[0] + rng.normal(size=(n // 10, dim)).astype(np.float32) * 0.05
    ids, wide = np.arange(n), x.astype(float)
    got = {}
    df = spark.createDataFrame(pa.table({"vec_id": ids, "embedding": pa.array(list(x), pa.list_(pa.float32())), "id": pa.array(["c"] * n)}))
    for r in ivfpq.neighbours(df, F.col("id") % 200 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in range(0, n, 200):
        rows = sorted(got[q])
        assert [r[0] for r in rows] == list(range(1, 21)) and q not in [r[1] for r in rows]
        assert [(-s, i) for _, i, s in rows] == sorted((-s, i) for _, i, s in rows)
        scores = (wide * wide[q]).sum(1)
        assert all(np.isclose(s, scores[i], rtol=1e-12) for _, i, s in rows)
        hits += len({r[1] for r in rows} & set([i for i in np.lexsort((ids, -scores)).tolist() if i != q][:20]))
    assert hits / (len(got) * 20) >= 0.9


def test_few_rows_are_scored_exactly(spark, monkeypatch):
    """The threshold lets at least RERANK rows of a query through, and without ties fewer than twice as many."""
    x = np.random.default_rng(6).normal(size=(20_000, 16))
    rows = spark.createDataFrame(pa.table({"id": np.arange(20_000), "v": pa.array(list(x), pa.list_(pa.float64()))}))
    index = ivfpq.fit(rows, 20_000, 5_000)
    index.probes = len(index.cells)
    with shared.Scratch(spark) as scratch:
        base = scratch.stored(ivfpq._indexed(rows, index), "base")
        tiles = ivfpq._tiles(base, index)
        asks = rows.filter("id % 1000 = 0")
        assert len(tiles.cuts) >= 2
        left, right = ivfpq._dealt(base.withColumn("grp", F.get(F.array(*map(F.lit, tiles.group.tolist())), F.col("cell"))), ivfpq._asked(asks, index, tiles), tiles)
        least = {r["query"]: r.least for r in ivfpq._thresholds(left, right, index).collect()}
    cell = index.assign(x)
    scores = ivfpq._scores(index, cell, index.encode(x, cell), x[::1000])
    reach = [(scores[:, k] >= least[1000 * k] - 1e-4).sum() for k in range(20)]
    assert all(ivfpq.RERANK <= n <= 2 * ivfpq.RERANK + 20 for n in reach)


def test_copies_tie_to_the_smaller_id(spark):
    rng = np.random.default_rng(3)
    x = [np.ones(4, np.float32)] * 200 + list(rng.normal(size=(50, 4)).astype(np.float32) * 0.1)
    got = ivfpq.neighbours(vectors(spark, range(250), x), F.col("id") % 20 == 0).collect()
    for q in range(0, 200, 20):
        mine = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
        assert mine == [i for i in range(22) if i != q][:20]


def test_vectors_that_take_no_part(spark):
    bad = [None, [0.0] * 4, [1.0, float("nan"), 0.0, 0.0], [float("inf")] * 4, [1.0, 2.0], []]
    good = [[1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.5, 0.5, 0.0, 0.0], [-1.0, 0.0, 0.0, 0.0]]
    rows = [(20 * i, v, 0, "c") for i, v in enumerate(bad + good)] + [(None, good[0], 0, "c"), (120, good[0], 1, "d")]
    rows[2] = (40, [1.0, None, 0.0, 0.0], 0, "c")
    got = ivfpq.neighbours(spark.createDataFrame(rows, VECTORS), F.col("id") % 20 == 0).collect()
    ids = [120, 140, 160, 180]
    assert sorted(r.query_id for r in got) == sorted(i for i in ids for _ in range(3))
    for k, q in enumerate(ids):
        mine = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
        assert mine == nearest_by_hand(ids, np.array(good, np.float32), k, 20)
    assert ivfpq.neighbours(spark.createDataFrame([], VECTORS), F.col("id") % 20 == 0).count() == 0


# --- pipeline


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(sf + "/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = shared.stored(stage(spark, docs, sf), name)
        assert out.columns == docs.columns and out.count() > 0
        if name == "near_duplicates":
            rows = {r.doc_id: r.text for r in docs.collect()}
            ids = sorted(rows)
            by = classes_by_hand([rows[i] for i in ids])
            assert {r.doc_id for r in out.collect()} == {ids[c] for _, c in by}
        if name == "substring_dedup":
            rows = sorted((r.doc_id, r.text) for r in docs.collect())
            want = removed_by_hand([t for _, t in rows], 35)
            got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
            for (i, text), (_, gone, kept) in zip(rows, want, strict=True):
                assert got[i][0] == (kept if gone else text) and got[i][1] == len(got[i][0])
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert pieces.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, sf).count() == pieces.count()


def test_pipeline_of_nothing(spark, sf, tmp_path):
    spark.read.parquet(sf + "/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(sf + "/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
