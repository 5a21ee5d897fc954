"""The driver contract: entry(), queries() and oracle_sql()."""

import __spark_entry__ as E
from conftest import SF


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert sum(r.n_runs for r in rows) == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_oracle_keys_subset_of_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


def test_queries_plan_on_small_data(spark):
    """Every query resolves (analysis only; the driver runs them)."""
    skip = {"manifest_scan", "fastq_scan", "fasta_scan", "fasta_index", "vcf_roundtrip", "variants_flat",
            "job_completion", "finalise_modes", "manifest_stream"}        # these write inputs first
    for name, fn in E.queries().items():
        if name not in skip:
            assert fn(spark, SF).columns, name
