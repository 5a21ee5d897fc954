"""Physical-plan properties the scale design relies on."""

from helixframe import standins as S
from helixframe.operators import align as A
from helixframe.plans import catalog
from conftest import SF


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_seed_join_is_sort_merge_not_broadcast(spark):
    index = A.kmer_index(A.tiles_from_contigs(S.standin(spark, SF, "contigs"), 100, 80, reference="ctg"), 15, 1, 100)
    plan = _plan(A.vote_hits(S.standin(spark, SF, "reads").select("read_id", "seq"), index, references=["ctg"]))
    assert "SortMergeJoin" in plan
    assert "BroadcastHashJoin" not in plan and "CartesianProduct" not in plan


def test_sample_filter_reaches_the_scan(spark):
    df = catalog.QUERIES["filter_samples"](spark, SF)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [In(c_mktsegment" in text or "c_mktsegment IN" in text.replace("In(", "IN(")


def test_no_cross_joins_anywhere(spark):
    skip = {"manifest_scan", "fastq_scan", "fasta_scan", "fasta_index", "vcf_roundtrip", "variants_flat",
            "job_completion", "manifest_stream", "sorted_alignments", "vcf_batches", "export_ledger",
            "genotypes", "region_query", "finalise_modes"}                      # these run actions while planning
    for name, fn in catalog.QUERIES.items():
        if name in skip:
            continue
        plan = _plan(fn(spark, SF))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
