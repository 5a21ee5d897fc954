"""Merkle manifests against trees built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from helixframe.llm import merkle_manifest as M
from helixframe.llm import queries

SF = "/root/testdata/sf0.001"
TYPES = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(hashes, fan=8):
    """Root, and for every leaf the siblings (left, right) of each level."""
    level, steps, at = list(hashes), [[] for _ in hashes], list(range(len(hashes)))
    while len(level) > 1:
        for i, k in enumerate(at):
            a = k // fan * fan
            steps[i].append((level[a:k], level[k + 1:a + fan]))
        level = [H(*level[k:k + fan]) for k in range(0, len(level), fan)]
        at = [k // fan for k in at]
    return (level[0] if level else None), steps


def plain(rows, fan=8):
    langs = sorted({r["lang"] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    groups = {lang: sorted((r for r in rows if r["lang"] == lang), key=lambda r: (
        r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]))) for lang in langs}
    trees = {lang: tree([leaf(r, r["text"]) for r in group], fan) for lang, group in groups.items()}
    root, upper = tree([trees[lang][0] for lang in langs], fan)
    out = []
    for k, lang in enumerate(langs):
        for r, own in zip(groups[lang], trees[lang][1], strict=True):
            now = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and now is not None:
                now = "".join(c.lower() if "A" <= c <= "Z" else c for c in now)
            steps = own + upper[k]
            folded = leaf(r, now)
            for a, b in steps:
                folded = H(*a, folded, *b)
            out.append((r["doc_id"], leaf(r, r["text"]), trees[lang][0], root, H(*[x for a, b in steps for x in a + b]), folded, folded == root))
    return out


def key(row):
    return tuple(map(str, row))


def test_query_against_plain_trees(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op11_merkle_manifest(spark, SF)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows), key=key)


@pytest.mark.parametrize("fan, levels", [(8, 4), (2, 2), (3, 1)])
def test_blocks_and_odd_rows(spark, fan, levels):
    """Several rounds of blocks; null, repeated and equal ids; a lone leaf; a null language; every size of last run."""
    rows = [dict(doc_id=i // 2 if i % 5 else i, text=f"Text {i}", lang="xx", source=None, n_chars=i) for i in range(37)]
    rows += [dict(doc_id=7, text="Same", lang="yy", source="s", n_chars=1)] * 9
    rows += [dict(doc_id=None, text=None, lang=None, source=None, n_chars=None), dict(doc_id=3, text="É Z", lang=None, source="", n_chars=0),
             dict(doc_id=9, text="", lang="", source="a:b", n_chars=-1), dict(doc_id=1, text="X" * 100_000, lang="zz", source="q", n_chars=5)]
    docs = spark.createDataFrame(rows, TYPES).withColumns({"leaf": F.lit("mine"), "tree": F.lit(1), "h": F.lit("x"), "n": F.lit(0)})
    got = M.verified(docs.repartition(3), M.Settings(fan, levels))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows, fan), key=key)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_sizes(spark, n):
    rows = [dict(doc_id=i, text=f"T{i}", lang="a", source=None, n_chars=i) for i in range(n)]
    got = M.verified(spark.createDataFrame(rows, TYPES), M.Settings(8, 1))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows), key=key)


def test_empty_table(spark):
    assert M.verified(spark.createDataFrame([], TYPES)).collect() == []


def test_leaves_meet_no_join(spark):
    """On the way down the path rides along in the groups: the leaves are in no join but that of their rank's offsets."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = M.manifest(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Cartesian" not in plan
