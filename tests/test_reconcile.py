"""Run reconciliation: the hand-written edge cases, one run per directory."""

import pytest
from pyspark.sql import functions as F

from helixframe.operators import manifest as M
from helixframe.operators import reconcile as R
from helixframe.sources.literal import from_values

KNOWN = ["ILLUMINA", "LS454"]
SCHEMA = "manifest_row long, run_id string, sample_id string, study_id string, layout string, platform string, raw string"
LAYOUTS = [("PAIRED", 2), ("SINGLE", 1), ("TRIPLE", 3)]


def classify(spark, runs, objects, repair=False, mode="prefix"):
    rows = [(i, r, s, "P", lay, plat, f"{r},{s}") for i, (r, s, lay, plat) in enumerate(runs)]
    m = spark.createDataFrame(rows, SCHEMA)
    m = M.expected_files(m, "gs://b", layout_files=from_values(spark, LAYOUTS, "layout string, n_files int"))
    objs = spark.createDataFrame([(p, 1) for p in objects], "path string, size long")
    out = R.classify_runs(m, objs, KNOWN, mode=mode, repair=repair, root="gs://b")
    return {r.manifest_row: r for r in out.collect()}


def names(row):
    return [f.name for f in row.found_files] if row.found_files is not None else None


def test_ok_paired_single_and_numeric_order(spark):
    res = classify(spark, [("R1", "S1", "PAIRED", "ILLUMINA"), ("R2", "S2", "SINGLE", "ILLUMINA"),
                           ("R3", "S3", "TRIPLE", "ILLUMINA")],
                   ["fastq/P/S1/R1_2.fastq", "fastq/P/S1/R1_1.fastq", "fastq/P/S2/R2_1.fastq",
                    "fastq/P/S3/R3_10.fastq", "fastq/P/S3/R3_2.fastq", "fastq/P/S3/R3_1.fastq"])
    assert res[0].status == "valid" and names(res[0]) == ["R1_1.fastq", "R1_2.fastq"]
    assert res[0].found_files[0].uri == "gs://b/fastq/P/S1/R1_1.fastq"
    assert res[1].status == "valid" and names(res[1]) == ["R2_1.fastq"]
    assert names(res[2]) == ["R3_1.fastq", "R3_2.fastq", "R3_10.fastq"]


def test_platform_is_exact_and_first(spark):
    res = classify(spark, [("R1", "S1", "PAIRED", "illumina"), ("R2", "S2", "UNKNOWN", "illumina"),
                           ("R3", "S3", "PAIRED", None)], [])
    assert res[0].status == "anomaly" and res[0].comment == "Unknown INSTRUMENT: illumina"
    assert res[0].found_files == []
    assert res[1].reason == "unknown_platform"          # platform before the empty file list
    assert res[2].comment == "Unknown INSTRUMENT: null"


def test_wrong_counts(spark):
    res = classify(spark, [("R1", "S1", "PAIRED", "ILLUMINA"), ("R2", "S2", "SINGLE", "ILLUMINA")],
                   ["fastq/P/S1/R1_1.fastq", "fastq/P/S2/R2_1.fastq", "fastq/P/S2/R2_2.fastq"])
    assert res[0].comment == "Wrong files number for runId (0/2)" and res[0].n_found == 1
    assert res[1].comment == "Wrong files number for runId (0/1)" and res[1].n_found == 2


def test_prefix_quirk_and_exact_mode(spark):
    runs = [("SRR12", "S1", "SINGLE", "ILLUMINA")]
    objs = ["fastq/P/S1/SRR12_1.fastq", "fastq/P/S1/SRR123_1.fastq"]
    assert classify(spark, runs, objs)[0].comment == "Wrong files number for runId (0/1)"
    assert classify(spark, runs, objs, mode="exact")[0].status == "valid"


def test_prefix_reaches_subdirectories(spark):
    res = classify(spark, [("R1", "S1", "PAIRED", "ILLUMINA")],
                   ["fastq/P/S1/R1_1.fastq", "fastq/P/S1/R1/extra_2.fastq"])
    assert res[0].status == "valid" and names(res[0]) == ["R1_1.fastq", "extra_2.fastq"]


def test_no_suffix_no_files_null_key(spark):
    res = classify(spark, [("R1", "S1", "SINGLE", "ILLUMINA"), ("R2", "S2", "OTHER", "ILLUMINA"),
                           (None, "S3", "SINGLE", "ILLUMINA")], ["fastq/P/S1/R1.fastq"])
    assert (res[0].status, res[0].reason) == ("dropped", "bad_suffix")
    assert (res[1].status, res[1].reason) == ("dropped", "no_files")
    assert (res[2].status, res[2].reason) == ("dropped", "null_key")


@pytest.mark.parametrize("objs,repair,status,comment,second", [
    (["SRR5_1", "SRR6_2"], False, "anomaly", "Wrong files number for runId (0/2)", None),
    (["SRR5_1", "SRR6_2", "SRR9_1"], True, "valid", None, "SRR6_2.fastq"),
    (["SRR5_2", "SRR6_1"], True, "anomaly", "Already tried with _1 paired index (1/2)", None),
    (["SRR5_1", "SRR9_2", "SRR9_1"], True, "anomaly", "File not found (1/2)", None),
    (["SRR5_1", "SRR9_2"], True, "valid", None, "SRR9_2.fastq"),
    (["SRR5_1", "SRR6_2", "ABC_9"], True, "dropped", None, None),   # unparsable run number before the match
])
def test_mate2_repair(spark, objs, repair, status, comment, second):
    res = classify(spark, [("SRR5", "S1", "PAIRED", "ILLUMINA")], [f"fastq/P/S1/{o}.fastq" for o in objs],
                   repair=repair)[0]
    assert res.status == status
    assert res.comment == comment
    if second:
        assert names(res)[1] == second


def test_anomaly_lines_and_audit(spark, tmp_path):
    rows = [(0, "R1", "S1", "P", "PAIRED", "ILLUMINA", "R1,S1,raw"), (1, "R2", "S2", "P", "SINGLE", "X", None)]
    m = M.expected_files(spark.createDataFrame(rows, SCHEMA).withColumn("center_name", F.lit("C")))
    objs = spark.createDataFrame([("fastq/P/S1/R1_1.fastq", 1)], "path string, size long")
    c = R.classify_runs(m, objs, KNOWN)
    lines = sorted(r.value for r in R.anomaly_lines(c).collect())
    assert lines == ["Unknown INSTRUMENT: X,null", "Wrong files number for runId (0/2),R1,S1,raw"]
    R.write_anomalies(c, str(tmp_path / "rep"), single_file=True)
    assert len([p for p in (tmp_path / "rep").iterdir() if p.name.startswith("part-")]) == 1
    audit = R.anomaly_audit(c, objs).collect()
    assert [(a.run_id, a.object_name) for a in audit] == [("R1", "fastq/P/S1/R1_1.fastq")]


def test_conservation_and_no_cartesian(spark):
    from helixframe.plans import catalog
    from conftest import SF
    c = catalog._classified(spark, SF)
    counts = {r.status: r["count"] for r in c.groupBy("status").count().collect()}
    assert sum(counts.values()) == spark.read.parquet(f"{SF}/orders.parquet").count()
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_run_ids_of_different_lengths_share_a_directory(spark):
    res = classify(spark, [("AB", "S1", "SINGLE", "ILLUMINA"), ("ABCDE", "S1", "SINGLE", "ILLUMINA")],
                   ["fastq/P/S1/AB_1.fastq", "fastq/P/S1/ABCDE_1.fastq"])
    assert res[0].comment == "Wrong files number for runId (0/1)" and res[0].n_found == 2
    assert res[1].status == "valid" and names(res[1]) == ["ABCDE_1.fastq"]
