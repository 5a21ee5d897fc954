"""Decontamination against plain Python sets of windows."""

import hashlib
import re

from pyspark.sql import functions as F

from helixframe.llm import decontaminate as D
from helixframe.llm import queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def plain(text, items):
    """Hit word positions, and the ids of items with occurring windows."""
    mine, hit, ids = words(text), set(), set()
    where = {}
    for k in {min(10, len(words(t))) for _, t in items}:
        for i in range(len(mine) - k + 1):
            where.setdefault(tuple(mine[i:i + k]), []).append(i)
    for item, t in items:
        of = words(t)
        k = min(10, len(of))
        for j in range(len(of) - k + 1) if k else ():
            for i in where.get(tuple(of[j:j + k]), ()):
                hit.update(range(i, i + k))
                ids.add(item)
    return len(mine), hit, ids


def test_query_against_plain_version(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op13_decontaminate(spark, SF).collect()
    assert len(got) == len(docs) and any(r.contaminated for r in got)
    for r in got:
        n, hit, ids = plain(docs[r.doc_id], items)
        digest = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, len(hit), len(ids), digest, bool(hit))


PASSAGE = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, PASSAGE), (10, PASSAGE.upper() + "!"), (2, "short item"), (3, None), (4, "?!"), (5, "one"), (5, "a b c d e f g h i j"), (None, "no id here"),
         (6, "é ü"), (2, "short item")]
TEXTS = [None, "", "...", "one", "nothing at all", f"pre {PASSAGE} post", f"PRE-{PASSAGE.upper()}-post", PASSAGE[:30], "Short, ITEM and no id\there",
         "a b c d e f g h i j k a b c d e f g h i j", "É ü é ü", ("x " * 70_000) + PASSAGE + " one", "short item " * 5000, " ".join(f"w{i}" for i in range(5, 14)),
         "one\u0000one", PASSAGE + " " + PASSAGE]


def frames(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[5]), (None, TEXTS[5]), (5, "other")], "doc_id long, text string")
    docs = docs.withColumns({"words": F.lit("mine"), "key": F.lit(1), "found": F.lit("x"), "pos": F.lit(2), "h": F.lit(3), "item_id": F.lit(9)})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("window", F.lit("mine"))
    return docs, items


def test_odd_texts_and_items(spark):
    docs, items = frames(spark)
    for settings in (D.Settings(), D.Settings(set_bytes=700)):  # in one part, and in several
        got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in D.contamination(docs, items, settings=settings).collect()]
        want = []
        for r in docs.collect():
            n, hit, ids = plain(r.text, ITEMS)
            ids = sorted(str(i) for i in ids - {None})
            want.append((r.doc_id, n, len(hit), len(ids), ids, bool(hit)))
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert D.contamination(docs.limit(0), items).collect() == []
    assert not any(r.contaminated for r in D.contamination(docs, items.limit(0)).collect())
    assert not any(r.contaminated for r in D.contamination(docs, items.where("item_id in (3, 4)")).collect())


def removed(text):
    if text is None:
        return None
    _, hit, _ = plain(text, ITEMS)
    out, at, last = "", 0, None
    for i, m in enumerate(WORD.finditer(text)):
        if i in hit:
            if last != i - 1:
                out += text[at:m.start()] + " "
            at, last = m.end(), i
        else:
            out, at = out + text[at:m.end()], m.end()
    return out + text[at:]


def test_removal(spark):
    docs, items = frames(spark)
    rows = docs.collect()
    clean = D.remove(docs, items)
    assert clean.columns == docs.columns
    got = sorted(map(str, map(tuple, clean.collect())))
    assert got == sorted(str((r.doc_id, removed(r.text), *tuple(r)[2:])) for r in rows)
    whole = D.remove(docs, items, "documents")
    assert sorted(map(str, map(tuple, whole.collect()))) == sorted(str(tuple(r)) for r in rows if not plain(r.text, ITEMS)[1])


def test_plan_is_native_and_probes_a_broadcast_set(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = D.contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
