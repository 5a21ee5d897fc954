"""The pipeline: its stages against the operators' brute-force versions, its contract, odd documents."""

import __spark_entry__ as E
import corpus_pipeline as C
from pyspark.sql import functions as F
from test_packing import check
from test_quality_mcd import plain
from test_secret_scan import base
from test_simhash_dedup import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def staged(spark, docs, tmp_path, sf):
    out = []
    for i, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, sf).write.parquet(f"file://{tmp_path}/{i}")
        docs = spark.read.parquet(f"file://{tmp_path}/{i}")
        out.append(docs)
    return out


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    language, quality, single, clean, packed = staged(spark, docs, tmp_path, SF)
    for part in (language, quality, single, clean):
        assert part.columns == docs.columns and part.dtypes == docs.dtypes
    whole = {r.doc_id: r for r in docs.collect()}
    spoken = {r.doc_id: r for r in language.collect()}
    assert all(any(c.isalpha() for c in r.text) for r in spoken.values()) and len(spoken) > 0.97 * len(whole)
    sound = {r.doc_id: r for r in quality.collect()}
    assert set(sound) <= {i for i, r in spoken.items() if not plain(r.text)[-1]}
    assert len(sound) > 0.95 * sum(not plain(r.text)[-1] for r in spoken.values())
    fps = [(i, plain_fingerprint(r.text)) for i, r in sound.items()]
    first = {i for (i, _), c in zip(fps, plain_components(fps), strict=True) if i == c}
    assert {r.doc_id for r in single.collect()} == first
    redacted = {r.doc_id: r.text for r in clean.collect()}
    assert set(redacted) == first
    assert all((redacted[i] == sound[i].text) or base(sound[i].text) for i in first)
    assert not any(base(t) for t in redacted.values())
    check(packed.collect(), list(redacted.items()))


def test_run_equals_its_stages_and_is_registered(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    last = staged(spark, docs, tmp_path, SF)[-1]
    assert E.queries()["pipeline"] is C.run and "pipeline" not in E.oracle_sql()
    columns = ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted(C.run(spark, SF).select(*columns).collect()) == sorted(last.select(*columns).collect())


def test_odd_documents(spark, tmp_path):
    good = "Some plain words stand here, " + " ".join(f"word{i}" for i in range(40))
    rows = [(1, good, "en", "a", 1), (1, good, "en", "a", 1), (2, good, None, None, None), (3, None, "en", "a", 1), (4, "", "en", None, 1),
            (None, good + " and more of it than before", "en", "a", 1), (5, "12 34 !!", "de", "a", 1), (6, "short one", "en", "a", 1),
            (7, "der hund und die katze sind im haus und " + " ".join(f"wort{i}x" for i in range(30)) + " token=abcdef99", "de", "b", 9)]
    out = staged(spark, spark.createDataFrame(rows, SCHEMA), tmp_path / "odd", SF)
    ids = [sorted(r.doc_id or 0 for r in part.collect()) for part in out[:4]]
    assert set(ids[1]) <= set(ids[0]) and 3 not in ids[0] and 4 not in ids[0] and 5 not in ids[0] and 6 not in ids[1]
    assert ids[2] == ids[3] and ids[2].count(1) == 1 and 2 not in ids[2] and 7 in ids[3]
    assert [r.text[-8:] for r in out[3].where("doc_id = 7").collect()] == ["<assign>"]
    empty = staged(spark, spark.createDataFrame([], SCHEMA), tmp_path / "empty", SF)
    assert [part.count() for part in empty] == [0] * 5


def test_near_duplicates_are_decided_row_by_row(spark):
    def text(tag):
        return " ".join(f"{tag}{i}" for i in range(60))
    rows = [(None, text("a"), "en", "s", 1), (None, text("b"), "en", "s", 1),           # different texts without ids
            (None, text("c"), "en", "s", 1), (None, text("c"), "de", None, 2), (None, text("c"), "de", None, 2),  # copies without ids
            (3, text("d"), "en", "s", 1), (5, text("d"), "en", "s", 1), (5, text("e"), "en", "s", 1),  # id 5: a copy, and a text of its own
            (7, text("f"), "en", "s", 1), (7, text("g"), "en", "s", 1), (7, text("g"), "en", "s", 1),  # one id, two texts, one of them twice
            (None, text("h"), "en", "s", 1), (9, text("h"), "en", "s", 1),               # an id goes before none
            (11, None, "x", None, 1), (11, "x", None, None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = C.simhash_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, (r.text or "")[:1]) for r in kept.collect()), key=str)
    assert got == sorted([(None, "a"), (None, "b"), (None, "c"), (3, "d"), (5, "e"), (7, "f"), (7, "g"), (9, "h"), (11, ""), (11, "x")], key=str)


def test_columns_of_any_name_pass_through(spark, tmp_path):
    names = ["score", "lang_pred", "n_words", "kept", "spans", "m0", "v10", "f3", "_text_of", "_row_key", "row_key", "blob", "fp", "_lang_id", "distance2"]
    good = "Some plain words stand here, " + " ".join(f"word{i}" for i in range(40))
    rows = [(i, f"{good} and number {i} " + " ".join(f"own{i}x{k}" for k in range(30)), "en", "a", 1) for i in range(6)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs = docs.select(*[F.concat(F.lit(f"{n}/"), F.col("doc_id").cast("string")).alias(n) for n in names], *docs.columns)
    for part in staged(spark, docs, tmp_path, SF)[:4]:
        assert part.columns == docs.columns
        for r in part.collect():
            assert [r[n] for n in names] == [f"{n}/{r.doc_id}" for n in names]
    assert part.count() == 6
