"""Overlap join and region lookup: intervals of any length, pruned files."""

import random

from pyspark.sql import functions as F

from helixframe.functions import intervals as I
from helixframe.operators import align as A

SCHEMA = "id long, contig string, start long, end long"


def brute(left, right):
    return sorted((a[0], b[0]) for a in left for b in right
                  if None not in a and None not in b and a[1] == b[1] and a[2] <= a[3] and b[2] <= b[3] and a[2] <= b[3] and b[2] <= a[3])


def joined(spark, left, right, bin_size):
    found = A.overlap_join(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), bin_size=bin_size)
    return sorted((r.l_id, r.r_id) for r in found.collect())


def mixed(rnd, n, longest):
    out = []
    for i in range(n):
        a = rnd.randint(1, longest)
        out.append((i, rnd.choice("cd"), a, min(longest, a + rnd.choice([0, 3, 40, 700, 9000, longest]))))
    return out


def test_intervals_of_all_lengths_against_brute_force(spark):
    rnd = random.Random(11)
    left, right = mixed(rnd, 150, 60_000), mixed(rnd, 120, 60_000)
    left += [(900, "c", 1, 60_000), (901, "c", 1, 60_000), (902, "d", 64, 64), (903, "d", 65, 64)]
    right += [(900, "c", 1, 60_000), (901, None, 1, 5), (902, "d", None, 5), (903, "d", 1, None)]
    assert joined(spark, left, right, 64) == brute(left, right)
    assert joined(spark, left[150:], right, 64) == brute(left[150:], right)
    assert joined(spark, left, right[:0], 64) == []


def test_a_very_long_interval_takes_a_row_per_level(spark):
    long, short = [(0, "c", 1, 3_000_000_000)], [(i, "c", 1 + i * 10_000_000, 50 + i * 10_000_000) for i in range(250)]
    assert joined(spark, long, short, 1000) == [(0, i) for i in range(250)]
    assert joined(spark, short, long, 1000) == [(i, 0) for i in range(250)]
    rows = spark.createDataFrame(long + short, SCHEMA)
    wide = A._binned(rows, ("contig", "start", "end"), 1000, "r_", None).groupBy("r_id", "r_start").count()
    assert wide.agg(F.max("count")).first()[0] <= 2 * (I.LEVELS + 1)


def test_short_intervals_do_not_meet_in_wide_bins(spark):
    """Where only one interval is long, the wide bins hold no pairs of short ones."""
    short = [(i, "c", 1 + 2000 * i, 50 + 2000 * i) for i in range(300)]
    right = [*[(i, "c", 1100 + 2000 * i, 1150 + 2000 * i) for i in range(300)], (999, "c", 1, 10_000_000)]
    left, other = spark.createDataFrame(short, SCHEMA), spark.createDataFrame(right, SCHEMA)
    a = A._binned(left, ("contig", "start", "end"), 1000, "l_", I.levels_present(other, "start", "end", 1000))
    b = A._binned(other, ("contig", "start", "end"), 1000, "r_", None)
    met = a.join(b, (a["l_contig"] == b["r_contig"]) & (a["_at"] == b["_at"])).count()
    assert met <= 300 + 600


def alignments(spark):
    rows = [(f"r{i}", "g", i % 4, f"c{i % 4}", 1 + (i * 37) % 5000, "A" * (30 if i % 50 else 2500)) for i in range(3000)]
    rows += [(f"u{i}", "g", None, None, None, "A" * 30) for i in range(20)]
    return spark.createDataFrame(rows, "read_id string, reference string, contig_idx int, contig string, pos long, seq string")


def test_region_lookup_reads_only_the_windows_of_the_index(spark, tmp_path):
    aln, at = alignments(spark), str(tmp_path / "laid")
    A.write_windows(aln, at, window=256)
    table = A.scan_windows(spark, at)
    index = A.index_alignments(aln, 256)
    assert table.where("pos IS NULL").count() == 20 and table.count() == aln.count()
    for contig, start, end in (("c1", 1000, 1100), ("c3", 4900, 9000), ("c0", 1, 1), ("none", 1, 10**6)):
        want = sorted(r.read_id for r in aln.where((F.col("contig") == contig) & (F.col("pos") <= end)
                                                   & (F.col("pos") + F.length("seq") - 1 >= start)).collect())
        found = A.query_region(table, index, contig, start, end, 256)
        assert sorted(r.read_id for r in found.collect()) == want
        plan = found._jdf.queryExecution().executedPlan()
        assert "dynamicpruning" in plan.toString()
        if contig == "c1":
            assert 0 < files_read(found) < 0.4 * len(table.inputFiles())
        assert set(found.columns) == set(aln.columns)


def files_read(df):
    """Files that the scan of an executed lookup opened."""
    plan = df._jdf.queryExecution().executedPlan().executedPlan()
    if plan.getClass().getSimpleName() == "ResultQueryStageExec":
        plan = plan.plan()
    leaves, n = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numFiles"):
            n += metrics.apply("numFiles").value()
    return n
