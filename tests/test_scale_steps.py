"""Steps that must not grow into one task, one exchange too many or a task per small range."""

import json
import random

from pyspark.sql import functions as F

from helixframe.functions.joins import broadcast_if_small
from helixframe.functions.paths import ancestor_at, ancestor_dirs, depth_of
from helixframe.operators import align as A
from helixframe.operators import reconcile as R
from helixframe.operators import variants as V
from helixframe.plans import jobs as J
from helixframe.session import apply_sql_defaults
from helixframe.sources import fasta as FA
from helixframe.sources import fastq as FQ
from helixframe.sources._files import ByteRange, pack_ranges


def test_ancestors_by_depth(spark):
    paths = spark.createDataFrame([("a/b/c.fastq",), ("c.fastq",), ("a//x",)], "path string")
    for r in paths.select("path", ancestor_dirs("path").alias("all"), depth_of("path").alias("deep")).collect():
        one = spark.createDataFrame([(r.path, d) for d in range(r.deep + 1)], "path string, d int")
        assert [x[0] for x in one.orderBy("d").select(ancestor_at("path", F.col("d"))).collect()] == r.all


def test_prefix_matches_at_several_depths(spark):
    keys = spark.createDataFrame([("", "a"), ("a/", "SRR1"), ("a/b/", "SRR1"), ("a/b/", "SRR12"), ("x", "SRR1")], "dir string, run_id string")
    objects = ["a/SRR1_1.fastq", "a/b/SRR12_1.fastq", "a/b/c/SRR1_2.fastq", "aa", "a/SRR", "x/SRR1"]
    got = R.match_run_files(keys, spark.createDataFrame([(o,) for o in objects], "path string"))
    want = {(d, r, o) for d, r in [tuple(k) for k in keys.collect()] for o in objects
            if o.startswith(d + r) and (d == "" or d.endswith("/"))}
    assert {(x.dir, x.run_id, x.path) for x in got.collect()} == want and got.count() == len(want)


def test_shared_ancestors_make_no_candidates(spark):
    """Only ancestors as deep as a run's directory are joined: no key holds an object of every directory."""
    keys = spark.createDataFrame([("fastq/p/", "SRR1")], "dir string, run_id string")
    plan = R.match_run_files(keys, spark.createDataFrame([("fastq/p/SRR1_1.fastq",)], "path string"))._jdf.queryExecution().toString()
    assert "sequence(0" not in plan


def test_small_ranges_share_tasks(tmp_path):
    ranges = [ByteRange("f", i * 1000, (i + 1) * 1000, 10_000_000) for i in range(10_000)]
    groups = pack_ranges(ranges, 8)
    assert [r for g in groups for r in g] == ranges and len(groups) < 50
    (tmp_path / "a.fastq").write_text("".join(f"@r{i}\nACGT\n+\nIIII\n" for i in range(500)))
    (tmp_path / "a.fa").write_text(">c\n" + "ACGT\n" * 500)
    for reader, name in ((FQ._FastqReader, "a.fastq"), (FA._FastaReader, "a.fa")):
        at = reader({"paths": json.dumps([str(tmp_path / name)]), "split_size": "64", "tasks": "4"})
        parts = at.partitions()
        assert 1 < len(parts) <= 6 and sum(len(p.ranges) for p in parts) > 30


def test_many_small_vcf_files_are_written_by_several_tasks(spark, tmp_path):
    rows = [("g", f"s{i:03d}", 0, "c", 5, "A", 9, 4, "T", 5, "0/1") for i in range(100)]
    calls = spark.createDataFrame(rows, "reference string, sample_id string, contig_idx long, contig string, pos long, ref string, "
                                        "depth long, ref_count long, alt string, alt_count long, genotype string")
    merged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    try:
        V.write_vcf(calls, str(tmp_path / "vcf"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
    assert len({f.name.split("-")[1] for f in (tmp_path / "vcf").rglob("part-*")}) > 1
    assert V.scan_vcf(spark, str(tmp_path / "vcf")).count() == 100


def test_kmer_index_moves_its_rows_once(spark):
    contigs = spark.createDataFrame([(0, "c0", "ACGTTGCAACGTNACGTTGCAACGT")], "contig_idx long, contig string, seq string")
    index = A.kmer_index(A.tiles_from_contigs(contigs, 16, 12, reference="g"), 5, 1, 16)
    assert index._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(code") == 1
    seq = "ACGTTGCAACGTNACGTTGCAACGT"
    kmers = [(i, seq[i:i + 5]) for i in range(len(seq) - 4) if "N" not in seq[i:i + 5]]
    many = {k: sum(x == k for _, x in kmers) for _, k in kmers}
    assert {(r.pos, r.occ) for r in index.collect()} == {(i, many[k] if many[k] > 1 else None) for i, k in kmers}


def test_few_asked_seeds_move_no_other_rows_of_the_index(spark):
    seq = "ACGTTGCAACGTNACGTTGCAACGT"
    contigs = spark.createDataFrame([(0, "c0", seq)], "contig_idx long, contig string, seq string")
    tiles = A.tiles_from_contigs(contigs, 16, 12, reference="g")
    whole = A.kmer_index(tiles, 5, 1, 16)
    asked = whole.where("pos IN (0, 3)").select("reference", "code").distinct()
    some = A.kmer_index(tiles, 5, 1, 16, asked)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [code" in plan and "LeftSemi" in plan and plan.count("hashpartitioning(code") == 1
    want = whole.join(asked, ["reference", "code"], "left_semi").select(*some.columns).collect()
    assert sorted(map(str, some.collect())) == sorted(map(str, want)) and len(want) > 2


def test_hits_meet_the_tiles_without_their_reads(spark, monkeypatch):
    seq = "ACGTTGCAACGTCACGATGCTTCGTAGGCTCA"
    contigs = spark.createDataFrame([(0, "c0", seq)], "contig_idx long, contig string, seq string")
    tiles = A.tiles_from_contigs(contigs, 16, 0, reference="g")
    reads = spark.createDataFrame([(1, seq[2:12], "I" * 10), (2, seq[10:22], "J" * 12), (3, "T" * 10, "K" * 10)], "read_id long, seq string, qual string")
    hits = spark.createDataFrame([(1, "g", 0, 2, 0, 2, 0, 60, False), (2, "g", 0, 10, 0, 2, 0, 60, False), (3, "g", *[None] * 7)],
                                 "read_id long, reference string, contig_idx long, start long, strand int, votes long, second_votes long, mapq int, repeat boolean")
    written, staged = {}, A.staged
    monkeypatch.setattr(A, "staged", lambda df, purpose: written.setdefault(purpose, df.columns) and staged(df, purpose))
    got = {r.read_id: r for r in A.verify_hits(hits, reads, tiles, 4, 16).collect()}
    assert not {"aseq", "aqual", "seq", "qual"} & set(written["hits"])
    assert [(got[i].pos, got[i].nm, got[i].ref_seq, got[i].qual[:1], got[i].flag) for i in (1, 2, 3)] == [
        (3, 0, seq[2:12], "I", 0), (11, 0, seq[10:22], "J", 0), (None, None, None, "K", 4)]


def test_vcf_files_are_opened_once(spark, tmp_path):
    rows = [("g", f"s{i}", 0, "c", 5, "A", 9, 4, "T", 5, "0/1") for i in range(4)]
    calls = spark.createDataFrame(rows, "reference string, sample_id string, contig_idx long, contig string, pos long, ref string, "
                                        "depth long, ref_count long, alt string, alt_count long, genotype string")
    at = str(tmp_path / "vcf")
    V.write_vcf(calls, at)
    scanned = V.scan_vcf(spark, at)
    assert "FileScan text" not in scanned._jdf.queryExecution().toString()
    assert {(r.sample_id, r.call_name) for r in scanned.collect()} == {(f"s{i}", f"s{i}") for i in range(4)}
    assert J._files_or_none(spark, at).select("sample_id", "reference").distinct().count() == 4
    assert J._files_or_none(spark, str(tmp_path / "none")) is None


def test_rounds_of_kmers_give_the_same_alignments(spark, monkeypatch):
    """A large reference is exchanged in parts, by the first base of the k-mers; each part is a written step."""
    rng = random.Random(7)
    contigs = [(i, f"c{i}", "".join(rng.choice("ACGT") for _ in range(90)) + ("NACGTACGTACGTAC" if i == 1 else "")) for i in range(3)]
    contigs.append((3, "c3", contigs[0][2]))
    tiles = A.tiles_from_contigs(spark.createDataFrame(contigs, "contig_idx long, contig string, seq string"), 32, 20, reference="g")
    reads = spark.createDataFrame([(10 * c + p, s[p:p + 20]) for c, _, s in contigs[:3] for p in (0, 13, 55)] + [(99, "T" * 20)],
                                  "read_id long, seq string")

    def aligned():
        return sorted(map(str, A.align_reads(reads, tiles, 5, 1, 2, 32, references=["g"]).collect()))

    whole, first = aligned(), A.kmer_index(tiles, 5, 1, 32, first="C").collect()
    every = A.kmer_index(tiles, 5, 1, 32).collect()
    assert sorted(map(str, first)) == sorted(str(r) for r in every if str(r.code).zfill(5)[0] == "1")
    written, staged = [], A.staged
    monkeypatch.setattr(A, "staged", lambda df, purpose: written.append(purpose) or staged(df, purpose))
    monkeypatch.setattr(A, "ROUND_BASES", 0)
    monkeypatch.setattr(A, "FEW", 0)
    assert aligned() == whole
    assert written.count("seed-hits") == 4 and written.count("asked-seeds") == 4
    assert written.count("verified") == 5  # the reads in four rounds, and those that were placed anew


def test_reads_and_tiles_are_not_exchanged_in_one_step(spark):
    """The bases under the reads are written before the reads are joined, so the disk holds one of the two exchanges."""
    seq = "ACGTTGCAACGTCACGATGCTTCGTAGGCTCA"
    tiles = A.tiles_from_contigs(spark.createDataFrame([(0, "c0", seq)], "contig_idx long, contig string, seq string"), 16, 0, reference="g")
    reads = spark.createDataFrame([(1, seq[3:13]), (2, seq[10:22]), (3, "T" * 10)], "read_id long, seq string")
    aln = A.align_reads(reads, tiles, 5, 1, 2, 16, references=["g"])
    verified = A.verify_hits(aln.where("pos IS NOT NULL").selectExpr(
        "read_id", "reference", "contig_idx", "pos - 1 AS start", "strand", "votes", "second_votes", "mapq", "repeat"), reads, tiles, 2, 16)
    assert "t_tile" not in verified._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.read_id, r.pos) for r in aln.collect()) == [(1, 4), (2, 11), (3, None)]
    # What is aligned is a scan of written tables: a range partition that samples it joins nothing a second time.
    assert "SortMergeJoin" not in aln._jdf.queryExecution().executedPlan().toString()


def test_windows_laid_out_in_rounds_hold_the_same_rows(spark, tmp_path):
    rows = [(i, "g" if i % 3 else "h", i % 4 if i % 7 else None, f"c{i % 4}", 10 * i + 1 if i % 7 else None, 0, "ACGT") for i in range(200)] * 2
    aln = spark.createDataFrame(rows, "read_id long, reference string, contig_idx long, contig string, pos long, strand int, seq string")
    tables = []
    for rounds in (1, 5):
        at = str(tmp_path / str(rounds))
        A.write_windows(aln, at, 64, 16, rounds)
        tables.append(sorted(map(str, A.scan_windows(spark, at).select(*aln.columns, *A.LAYOUT).collect())))
    assert tables[0] == tables[1] and len(tables[0]) == len(rows)


def test_shuffle_files_go_with_their_step(spark):
    """The disk holds the shuffle files of one step, not of all steps of a query."""
    apply_sql_defaults(spark)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


def test_a_table_is_counted_without_a_limit(spark):
    """A limit sends up to so many rows of every partition to one task."""
    seen = []
    df = spark.range(10)
    df.limit = lambda n: seen.append(n)
    assert broadcast_if_small(df, 9) is df and not seen
    assert "broadcast" in broadcast_if_small(df, 10)._jdf.queryExecution().toString().lower()


def test_loaded_reads_are_made_once(spark):
    """Sizes, pairs and range samples read a written table: neither files nor rows are parsed or joined again for each."""
    rows = [(f"r{i}", "SRR1" if i < 3 else "SRR2", 1 + i % 2, i, "ACGT", "IIII") for i in range(6)]
    given = spark.createDataFrame(rows, "read_id string, run_id string, mate int, ordinal long, seq string, qual string")
    valid = spark.createDataFrame([("SRR1",), ("SRR1",)], "run_id string")
    reads, sizes = J._reads(J.JobConfig(output_root="x", known_platforms=[]), valid, None, J.JobInputs(reads=given))
    assert [(r.run_id, r.run_bytes) for r in sizes.collect()] == [("SRR1", 24)] and reads.count() == 3
    for df in (reads, sizes, J._paired(reads)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "LogicalRDD" not in plan and "LocalRelation" not in plan
