"""Fill-in-middle against a plain version, and the round trip."""

import hashlib
import re

from pyspark.sql import functions as F

from helixframe.llm import fill_in_middle as FIM
from helixframe.llm import queries

SF = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text):
    text = text or ""
    ends = [0] + [m.end() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", text)]
    n = len(ends) - 1
    digest = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = (ends[k] for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_query_against_plain_version(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op12_fill_in_middle(spark, SF).collect()
    assert len(got) == len(docs) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        n, form, a, m, output = plain(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (
            n, form, a, m, sha(output), sha(docs[r.doc_id] or ""))


ODD = [None, "", "a", "ab", "é", "<", "<P", "<<S", "<P><S>", "x<M>y", "P>S>M><", "S>\n<M\n>P>", "𝒳 y\u0000z\r\n", "<" * 50, "word " * 40_000, "a" * 300_000,
       "< P> <S <M", "tail<", "\\E\\Q<P\\E"]


def test_odd_texts_and_round_trip(spark):
    rows = [(i, t) for t in ODD for i in range(40)] + [(None, "null id"), (None, "null id"), (7, "ab"), (7, "ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"form": F.lit("mine"), "_text": F.lit("x"), "n": F.lit(1)})
    found = FIM.transform(docs).withColumn("back", FIM.restored(F.col("output"), F.col("form"))).collect()
    want = sorted(map(str, [(i, *plain(i, t), t or "") for i, t in rows]))
    assert sorted(map(str, map(tuple, found))) == want
    assert FIM.transform(docs.limit(0)).collect() == []


def test_no_marker_forms_across_a_border():
    """The proper starts of a marker are no ends of one, so only the inserted markers are found."""
    s = FIM.Settings()
    markers = (s.prefix, s.suffix, s.middle)
    for a in markers:
        for b in markers:
            assert not any(a.endswith(b[:k]) for k in range(1, len(b)))
