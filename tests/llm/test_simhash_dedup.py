"""SimHash near-duplicates against all pairs."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from helixframe.llm import queries
from helixframe.llm import simhash_dedup as S

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=3):
    """fps: list of (id, fingerprint). Least id reachable per position."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(fps):
        r = find(i)
        least[r] = min(least.get(r, doc), doc)
    return [least[find(i)] for i in range(len(fps))]


def test_query_against_all_pairs(spark):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {d: (f"{fp:016x}", c) for (d, fp), c in zip(rows, plain_components(rows), strict=True)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op8_simhash(spark, SF).collect()}
    assert got == want and any(d != c for d, (_, c) in got.items())


def chained(rng, n):
    """Clusters, long chains of small steps, and unrelated values."""
    out = [int(x) for x in rng.integers(0, 1 << 64, n // 4, dtype=np.uint64)]
    while len(out) < n:
        x = out[rng.integers(len(out))] if rng.random() < 0.3 else out[-1]
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            x ^= 1 << int(b)
        out.append(x)
    return out


def test_links_and_components_with_small_blocks(spark):
    rng = np.random.default_rng(3)
    fps = chained(rng, 700)
    distinct = sorted({np.uint64(x).view(np.int64).item() for x in fps})
    frame = spark.createDataFrame([(x,) for x in distinct], "fp long")
    for block in (5, 10_000):
        edges = S.links(frame, S.Settings(block=block))
        roots = {r.node: r.root for r in S.components(edges).collect()}
        as_unsigned = [(x, int(np.int64(x).view(np.uint64))) for x in distinct]
        want = dict(zip(distinct, plain_components(as_unsigned), strict=True))
        assert {x: roots.get(x, x) for x in distinct} == want


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 5000)]
    got = {r.node: r.root for r in S.components(spark.createDataFrame(edges, "v long, u long")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(400)}
    assert S.components(spark.createDataFrame([], "v long, u long")).count() == 0


def test_odd_rows(spark):
    texts = [None, "", " \t\n", "one", "ONE", "one two", "É x y z", "é x y z", "long " * 40_000, "long " * 40_000, "a\x0bb\x0cc d"]
    rows = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(3, "one", 0), (None, "one", 0)],
                                 "doc_id long, text string, fp long")
    got = S.near_duplicates(rows).collect()
    assert len(got) == len(texts) + 2
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by[i].component_id for i in range(5)] == [0, 0, 0, 3, 3] and by[9].component_id == 8
    assert [r.component_id for r in got if r.doc_id is None] == [3]
    for i, t in enumerate(texts):
        assert by[i].fp % (1 << 64) == plain_fingerprint(t)
    assert S.near_duplicates(rows.limit(0)).count() == 0


def test_plan_deals_by_unit(spark):
    frame = spark.range(100).select(F.xxhash64("id").alias("fp"))
    plan = S.links(frame, S.Settings())._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
