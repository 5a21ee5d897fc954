"""Exact top-k against sorting all scores."""

import math
from collections import Counter

import numpy as np

from helixframe.llm import queries
from helixframe.llm import topk_nra as K

SF = "/root/testdata/sf0.001"


def plain(rows, is_query, k):
    """Rows (query, rank, id, score) with how often each is there."""
    whole = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for at, (q, w) in enumerate(whole):
        if is_query(q):
            best = sorted((-sum(a * b for a, b in zip(w, v, strict=True)), i) for n, (i, v) in enumerate(whole)
                          if n != at and len(v) == len(w))[:k]
            out.update((q, n + 1, i, -s) for n, (s, i) in enumerate(best))
    return out


def rows_of(df):
    return Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_query_against_all_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert rows_of(queries.op4_topk_nra(spark, SF)) == plain(rows, lambda q: q % 20 == 0, 20)


def test_blocks_depths_and_ties():
    rng = np.random.default_rng(2)
    for n, dims, spread in ((5, 3, 4), (60, 8, 2), (300, 16, 9), (300, 2, 40)):
        vectors = rng.integers(-spread, spread + 1, (n, dims)).astype(float)
        ids = rng.permutation(n * 3)[:n]
        want = plain([(int(i), (v / 64).tolist()) for i, v in zip(ids, vectors, strict=True)], lambda q: True, 6)
        for depths in ((), (0.5,), (0.05, 0.2, 0.5, 0.9), tuple(i / 40 for i in range(40))):
            got = K.best_of_block(ids, vectors, ids, vectors, 6, K.Settings(chunk=7, depths=depths))
            assert {(int(ids[r.query]), r.vec_id, r.score) for r in got.itertuples()} == {(q, i, s) for q, _, i, s in want}


def skewed(n=4000, dims=16, seed=1):
    """Topics: a vector is large in two dimensions and zero in the others."""
    rng = np.random.default_rng(seed)
    vectors = np.zeros((n, dims))
    for row in vectors:
        row[rng.choice(dims, 2, replace=False)] = np.floor(rng.pareto(1.5, 2) * 20)
    return vectors


FINE = K.Settings(depths=tuple(i / 64 for i in range(1, 64)))


def test_a_query_stops_before_its_lists_end():
    vectors = skewed()
    ids = np.arange(len(vectors))
    got = K.best_of_block(ids[:100], vectors[:100], ids, vectors, 10, FINE)
    depths = got.groupby("query")["depth"].first()
    assert depths.median() < 0.1 * len(vectors) and depths.max() < len(vectors)


def test_entries_behind_the_depth_read_do_not_decide():
    """Candidates that no list has shown when the query stops are out, whatever they hold behind the last entry read."""
    vectors = skewed(2000)
    query, ids = vectors[3:4], np.arange(2000)
    found = K.best_of_block(ids[3:4], query, ids, vectors, 10, FINE)
    depth = found["depth"][0]
    used = np.flatnonzero(query[0])
    seen = (K.Lists(vectors).places[:, used] >= len(vectors) - depth).any(axis=1)
    seen[3] = True
    assert 0 < depth < len(vectors) and (~seen).sum() > 100
    other = np.where(seen[:, None], vectors, 0)
    again = K.best_of_block(ids[3:4], query, ids, other, 10, FINE)
    assert found["score"].tolist() == again["score"].tolist()


def test_scores_are_read_from_the_lists_alone():
    """After the lists are built, the entries that ``read`` hands out are all that the scores are made of."""
    vectors = skewed(500, 6).astype(np.float64)
    parts = [K.Lists(vectors).read(np.arange(500), True, a, b) for a, b in ((0, 100), (100, 350), (350, 500))]
    assert (sum(parts) + vectors.min(axis=0) == vectors).all()


def test_wide_integers_stay_exact():
    big = np.array([[2.0**30, 1], [2.0**30, 2], [2.0**30 + 64, 0]])
    assert K.exact_type(big, big) is object
    ids = np.arange(3)
    got = K.best_of_block(ids, big, ids, big, 1)
    assert got["score"].tolist() == [2**60 + 2**36, 2**60 + 2**36, 2**60 + 2**36]


def test_depth_of_every_query(spark):
    rows = [(i, (v / 64).tolist()) for i, v in enumerate(skewed(3000))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = K.top_k(frame, lambda i: i % 20 == 0, 5, settings=FINE, with_depth=True).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == plain(rows, lambda q: q % 20 == 0, 5)
    assert np.median([r.depth for r in got]) < 0.2


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.1, 0.2]), (20, [0.1, 0.2]), (1, None), (2, [None, 0.1]), (3, [nan, 0.1]), (4, [0.2, -inf]), (5, [0.5, 0.1]),
            (5, [0.5, 0.1]), (6, [1.0]), (40, [-1.0]), (60, []), (None, [0.1, 0.1]), (7, [-0.001, 3e9])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    assert rows_of(K.top_k(frame, lambda i: i % 20 == 0, 2)) == plain(rows, lambda q: q % 20 == 0, 2)
    assert K.top_k(frame.limit(0), lambda i: i % 20 == 0).count() == 0
    twins = frame.where("vec_id = 5")
    assert rows_of(K.top_k(twins, lambda i: i % 5 == 0)) == Counter({(5, 1, 5, 32 * 32 + 6 * 6): 2})
    assert K.top_k(twins.limit(1), lambda i: i % 5 == 0).count() == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    rng = np.random.default_rng(7)
    rows = [(20 * int(i) if i < 3 else int(i), rng.normal(0, 0.2, 4).tolist()) for i in rng.integers(0, 30, 150)]
    rows += rows[:40] + rows[:20]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    for settings in (K.Settings(), K.Settings(candidates=40, queries=4)):
        assert rows_of(K.top_k(frame, lambda i: i % 20 == 0, 7, settings=settings)) == plain(rows, lambda q: q % 20 == 0, 7)


def test_many_units(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.1, 6).tolist() if i % 3 else [0.1] * 6) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = K.top_k(frame, lambda i: i % 20 == 0, 5, settings=K.Settings(candidates=30, queries=4, chunk=2, depths=(0.3, 0.6)))
    assert rows_of(got) == plain(rows, lambda q: q % 20 == 0, 5)
