"""Registered queries: one per operator family, each over whole driver tables.

Every ``q_*`` takes (spark, sf_dir) and returns a lazy DataFrame; ``ORACLE``
holds the equivalent DuckDB SQL (same column names) where one exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe import standins as S
from helixframe.operators import manifest as M
from helixframe.functions.rank import global_rank
from helixframe.operators import align as A
from helixframe.operators import export as X
from helixframe.operators import reads as RD
from helixframe.operators import reconcile as R
from helixframe.operators import resume as P
from helixframe.operators import variants as V
from helixframe.plans import jobs as J
from helixframe.streaming.manifest_stream import start_manifest_stream
from helixframe.session import apply_sql_defaults, cut_lineage, ship_package, staged, staging_dir
from helixframe.sources.literal import from_values
from helixframe.sources import fasta as FA
from helixframe.sources import fastq as FQ
from helixframe.sources.manifest import scan_manifest

# Fixed parameters of the checked queries.
KNOWN_PLATFORMS = ["ILLUMINA", "LS454"]
SRC_ROOT = "gs://seq-runs"


def _t(spark, sf, name):
    return S.load_table(spark, sf, name)


def _manifest(spark, sf) -> DataFrame:
    m = S.standin(spark, sf, "manifest").withColumnRenamed("n", "manifest_row")
    return M.expected_files(m, SRC_ROOT)


def _classified(spark, sf, repair=False, mode="prefix") -> DataFrame:
    return R.classify_runs(_manifest(spark, sf), S.standin(spark, sf, "objects"), KNOWN_PLATFORMS,
                           mode=mode, repair=repair, root=SRC_ROOT)


def _names(col):
    return F.array_join(F.transform(col, lambda x: x["name"]), ",")


# ---------------------------------------------------------------- manifest


def q_manifest_scan(spark: SparkSession, sf: str) -> DataFrame:
    """M1+M2: write the manifest as comma files (one header order) and tab files
    (another order, other header aliases), then scan both in one pass."""
    m = S.standin(spark, sf, "manifest")
    out = staging_dir(spark, "manifest-scan")
    (m.where(F.col("n") % 2 == 0)
     .select(F.col("run_id").alias("Run"), F.col("sample_id").alias("SRA_Sample"), F.col("center_name").alias("Center_Name"),
             F.col("layout").alias("LibraryLayout"), F.col("platform").alias("Platform"), F.col("study_id").alias("SRA_Study"),
             F.lit("2011-10-12").alias("ReleaseDate"))
     .write.option("header", True).csv(f"{out}/comma"))
    (m.where(F.col("n") % 2 == 1)
     .select(F.col("platform").alias("platform"), F.col("study_id").alias("studyId"), F.col("layout").alias("LibraryLayout"),
             F.col("run_id").alias("runId"), F.col("sample_id").alias("sampleId"), F.col("center_name").alias("Center_Name"),
             F.lit("2014-07-17T00:00:00Z").alias("ReleaseDate"))
     .write.option("header", True).option("sep", "\t").csv(f"{out}/tab"))
    scanned = M.normalise_manifest(scan_manifest(spark, [f"{out}/comma", f"{out}/tab"]))
    return scanned.select("run_id", "sample_id", "study_id", "layout", "platform", "center_name",
                          F.date_format("release_ts", "yyyy-MM-dd").alias("release_day"))


def q_manifest_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """M1+M3: a manifest whose run column stands behind 140 others, and one without a header line, whose
    rows all go to quarantine."""
    m = S.standin(spark, sf, "manifest")
    out = staging_dir(spark, "manifest-quarantine")
    cells = [F.col("sample_id").alias("SRA_Sample"), F.col("layout").alias("LibraryLayout"), F.col("platform").alias("Platform"),
             F.col("study_id").alias("SRA_Study")]
    wide = [F.lit(f'x,"{i}"').alias(f"c{i}") for i in range(140)]
    m.where(F.col("n") % 3 != 0).select(*wide, *cells, F.col("run_id").alias("Run")).write.option("header", True).option("compression", "gzip").csv(f"{out}/wide")
    m.where(F.col("n") % 3 == 0).select("run_id", "sample_id", "study_id").write.csv(f"{out}/bare")
    good, bad = M.validate_manifest(M.normalise_manifest(scan_manifest(spark, [f"{out}/wide", f"{out}/bare"])))
    good = good.select("run_id", "sample_id", "layout", F.lit(None).cast("string").alias("raw"), F.lit("").alias("reasons"))
    bad = bad.select("run_id", "sample_id", "layout", "raw", F.array_join("reasons", ";").alias("reasons"))
    return good.unionByName(bad)


def q_manifest_required(spark, sf):
    d = M.normalise_fields(S.standin(spark, sf, "manifest_dirty"))
    good, bad = M.validate_manifest(d)
    good = good.select("n", "run_id", "layout", F.lit(True).alias("ok"), F.lit("").alias("reasons"))
    bad = bad.select("n", "run_id", "layout", F.lit(False).alias("ok"), F.array_join("reasons", ";").alias("reasons"))
    return good.unionByName(bad)


def _segment_samples(spark, sf, segments):
    c = _t(spark, sf, "customer")
    return c.where(F.col("c_mktsegment").isin(segments)).select(
        F.concat(F.lit("SRS"), (F.col("c_custkey") + 100000).cast("string")).alias("sample_id"))


def q_filter_samples(spark, sf):
    m = S.standin(spark, sf, "manifest")
    include = _segment_samples(spark, sf, ["BUILDING", "MACHINERY"])
    c = _t(spark, sf, "customer")
    skip = c.where(F.col("c_nationkey") == 3).select(
        F.concat(F.lit("SRS"), (F.col("c_custkey") + 100000).cast("string")).alias("sample_id"))
    return M.filter_samples(m, include=include, skip=skip).select("n", "run_id", "sample_id")


def q_expected_files(spark, sf):
    m = S.standin(spark, sf, "manifest")
    layouts = from_values(spark, [("PAIRED", 2), ("SINGLE", 1)], "layout string, n_files int")
    e = M.expected_files(m, SRC_ROOT, layout_files=layouts)
    return e.select("run_id", "dir", F.posexplode("files").alias("pos", "f")).select(
        "run_id", "dir", (F.col("pos") + 1).alias("mate"), F.col("f.uri").alias("uri"), F.col("f.path").alias("path"))


def q_group_by_sample(spark, sf):
    g = M.group_by_sample(_manifest(spark, sf), with_files=True)
    return g.select("sample_id", "n_runs", "min_run", "max_run", "n_platforms", "n_files")


def q_references_json(spark, sf):
    items = S.standin(spark, sf, "reference_json")
    docs = items.groupBy("doc_key").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("item"), ","), F.lit("]")).alias("json"))
    refs = M.references_from_json(docs, "json")
    names = _segment_samples(spark, sf, ["BUILDING"]).select(
        F.concat(F.lit("ctg"), F.expr("CAST(CAST(substring(sample_id, 4) AS BIGINT) - 100000 AS STRING)")).alias("name"))
    return M.filter_references(refs, names).select("doc_key", "name", "fasta_uri", "index_uri")


# ---------------------------------------------------------------- reconciliation


def q_parse_objects(spark, sf):
    return R.parse_objects(S.standin(spark, sf, "objects")).select("path", "dir", "name", "suffix", "size")


def q_match_prefix(spark, sf):
    return R.match_run_files(_manifest(spark, sf), S.standin(spark, sf, "objects"), "prefix").select("dir", "run_id", "path")


def q_match_exact(spark, sf):
    return R.match_run_files(_manifest(spark, sf), S.standin(spark, sf, "objects"), "exact").select("dir", "run_id", "path")


def q_file_exists(spark, sf):
    e = _manifest(spark, sf).select("run_id", F.posexplode("files").alias("pos", "f")).select(
        "run_id", (F.col("pos") + 1).alias("mate"), F.col("f.path").alias("path"))
    return R.object_exists(e, S.standin(spark, sf, "objects")).select("run_id", "mate", "path",
                                                                      F.col("exists").alias("present"))


def _status_cols(c: DataFrame) -> DataFrame:
    return c.select("run_id", "status", "reason", "comment", "n_found", "n_expected",
                    F.when(F.col("status") == "valid", _names(F.col("found_files"))).alias("files"))


def q_run_status(spark, sf):
    return _status_cols(_classified(spark, sf))


def q_run_status_exact(spark, sf):
    return _status_cols(_classified(spark, sf, mode="exact"))


def q_mate_order(spark, sf):
    valid, _ = R.split_runs(_classified(spark, sf))
    return valid.select("run_id", F.posexplode("found_files").alias("pos", "f")).select(
        "run_id", (F.col("pos") + 1).alias("mate_rank"), F.col("f.name").alias("name"), F.col("f.uri").alias("uri"))


def q_repair_mate2(spark, sf):
    return _status_cols(_classified(spark, sf, repair=True))


def q_anomaly_lines(spark, sf):
    return R.anomaly_lines(_classified(spark, sf))


def q_anomaly_audit(spark, sf):
    return R.anomaly_audit(_classified(spark, sf), S.standin(spark, sf, "objects")).select(
        "center_name", "sample_id", "run_id", "object_name")


def q_run_status_counts(spark, sf):
    """Flagship: status counts per reason (the reconciliation summary)."""
    c = _classified(spark, sf)
    return c.groupBy("status", "reason").agg(F.count("*").alias("n_runs"))


# ---------------------------------------------------------------- resume / completion

REFERENCE_NAMES = [("ctg",), ("alt",)]
DV_MIN_SIZE, DV_MAX_SIZE = 100000, 450000
EXPORT_PATTERN = "variants_%s"


def _resume_inputs(spark, sf):
    runs = S.standin(spark, sf, "manifest")
    refs = from_values(spark, REFERENCE_NAMES, "name string")
    return runs, refs, S.standin(spark, sf, "stage_objects")


def q_pending_align(spark, sf):
    return P.pending(*_resume_inputs(spark, sf), "align").select("run_id", "reference", "align_path")


def q_pending_sort(spark, sf):
    return P.pending(*_resume_inputs(spark, sf), "sort").select("run_id", "reference", "sort_path")


def q_pending_merge(spark, sf):
    return P.pending(*_resume_inputs(spark, sf), "merge").select("sample_id", "reference", "n_runs", "n_sorted")


def q_pending_index(spark, sf):
    return P.pending(*_resume_inputs(spark, sf), "index").select("sample_id", "reference", "index_path")


def q_pending_dv(spark, sf):
    return P.pending(*_resume_inputs(spark, sf), "dv", DV_MIN_SIZE, DV_MAX_SIZE).select(
        "sample_id", "reference", "merged_size", "dv_path")


def q_completion(spark, sf):
    return P.completion_status(*_resume_inputs(spark, sf)).select(
        "sample_id", "reference", "n_runs", "n_aligned", "n_sorted", "merged", "indexed", "called", "complete")


def q_completion_csv(spark, sf):
    return P.completion_lines(P.completion_status(*_resume_inputs(spark, sf)))


def _dv_files(spark, sf):
    return S.standin(spark, sf, "stage_objects").where(F.col("stage") == "dv").select("path", "size")


def q_vcf_batches(spark, sf):
    return X.batch_files(_dv_files(spark, sf), 50).select("path", "file_rank", "batch")


def q_export_ledger(spark, sf):
    files = _dv_files(spark, sf)
    # Files of every third sample were exported by an earlier run.
    ledger = files.where(F.expr("CAST(substring(regexp_extract(path, '/(SRS[0-9]+)_', 1), 4) AS BIGINT) % 3 = 0"))
    return X.plan_exports(files, ledger, EXPORT_PATTERN, 50).select("path", "reference", "table_name", "file_rank", "batch")


# ---------------------------------------------------------------- reads and references

FASTQ_SPLIT = 256 << 10   # small byte ranges so records cross range edges in the check
FASTA_SPLIT = 64 << 10
TILE, TILE_OVERLAP = 100, 20


RUNS_PER_FILE = 2000   # runs in one written FASTQ file, so that the files grow in number with the data


def _write_fastq(spark, sf, compression="none", broken=False):
    """The reads as FASTQ files, one per block of runs, in the order of run, mate and ordinal.  ``broken`` gives
    the first record of some runs a quality line longer than its sequence."""
    mates = S.standin(spark, sf, "read_mates").withColumn("n", F.substring("run_id", 4, 20).cast("bigint") - 1000000)
    named = mates.withColumns({"name": F.concat(F.col("name"), F.lit("/"), F.col("mate").cast("string")),
                               "block": F.floor(F.col("n") / RUNS_PER_FILE)})
    if broken:
        bad = (F.col("n") % 37 == 5) & (F.col("mate") == 1) & (F.col("ordinal") == 1)
        named = named.withColumn("qual", F.when(bad, F.concat("qual", F.lit("@"))).otherwise(F.col("qual")))
    out = staging_dir(spark, "fastq")
    (named.withColumn("value", FQ.fastq_record("name")).repartition("block").sortWithinPartitions("block", "run_id", "mate", "ordinal").select("block", "value")
     .write.partitionBy("block").option("compression", compression).text(out))
    return out


def _scanned(reads):
    """Run, mate and the record's number in its run from the name, the file's block from its path, and the
    record's computed number in the file."""
    tok = F.split(F.col("name"), "/")
    head = F.element_at(tok, 1)
    return reads.select(F.regexp_extract("path", "block=([0-9]+)", 1).cast("bigint").alias("block"), "ordinal",
                        F.substring_index(head, ".", 1).alias("run_id"), F.element_at(tok, 2).cast("int").alias("mate"),
                        F.substring_index(head, ".", -1).cast("bigint").alias("read"), "seq", "qual", "malformed")


def q_fastq_scan(spark, sf):
    """read_mates written as FASTQ text, scanned back by byte range."""
    return _scanned(FQ.scan_fastq(spark, _write_fastq(spark, sf), split_size=FASTQ_SPLIT))


def q_fastq_gz_scan(spark, sf):
    """F1 over compressed files."""
    return _scanned(FQ.scan_fastq(spark, _write_fastq(spark, sf, "gzip"), split_size=FASTQ_SPLIT))


def q_fastq_malformed(spark, sf):
    """F1 with broken records, at two split sizes and from a table of files."""
    out = _write_fastq(spark, sf, broken=True)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(out).select("path", F.col("length").alias("size"))
    scans = [("small", FQ.scan_fastq(spark, out, split_size=FASTQ_SPLIT // 16)), ("large", FQ.scan_fastq(spark, out)),
             ("table", FQ.scan_fastq_files(files, FASTQ_SPLIT))]
    parts = [_scanned(reads).withColumn("scan", F.lit(name)) for name, reads in scans]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_mate_pairs(spark, sf):
    """F2 where every third record of mate 1 is there a second time, read backwards."""
    reads = S.standin(spark, sf, "read_mates")
    again = reads.where("mate = 1 AND ordinal % 3 = 0").withColumn("seq", F.reverse("seq"))
    p = RD.pair_mates(reads.unionByName(again))
    return p.select("run_id", "ordinal", "copy", "status", F.col("r1.seq").alias("seq1"), F.col("r2.seq").alias("seq2"))


def _run_of_object(path_col):
    return F.regexp_extract(path_col, r"/(SRR[0-9]+)[^/]*$", 1)


def q_read_chunks(spark, sf):
    objs = S.standin(spark, sf, "objects").withColumn("run_id", _run_of_object(F.col("path")))
    sizes = RD.run_sizes(objs)
    ch = RD.chunk_reads(S.standin(spark, sf, "read_mates"), sizes, max_bytes=400000, chunk_records=2)
    return ch.select("run_id", "mate", "ordinal", "chunk")


def _write_fasta(spark, sf, compression="none"):
    out = staging_dir(spark, "fasta")
    (FA.fasta_text(S.standin(spark, sf, "contigs").repartitionByRange("contig_idx").sortWithinPartitions("contig_idx"))
     .write.option("compression", compression).text(out))
    return out


def q_fasta_scan(spark, sf):
    tiles = FA.scan_fasta(spark, _write_fasta(spark, sf), TILE, TILE_OVERLAP, split_size=FASTA_SPLIT)
    return tiles.select("contig", "tile", "start", "seq")


def q_fasta_gz_scan(spark, sf):
    """F4 over compressed files."""
    tiles = FA.scan_fasta(spark, _write_fasta(spark, sf, "gzip"), TILE, TILE_OVERLAP, split_size=FASTA_SPLIT)
    return tiles.select("contig", "tile", "start", "seq")


def q_fasta_index(spark, sf):
    located = FA.located_lines(FA.scan_fasta_lines(spark, _write_fasta(spark, sf), FASTA_SPLIT))
    return RD.fasta_index(located).select("contig", "length", "linebases", "linewidth")


# ---------------------------------------------------------------- alignment

K, MAX_OCC, MAX_MM = 15, 1, 4
ATILE, ATILE_OVERLAP = 100, 80
LAYOUT_ROUNDS = 8   # in which many alignments are laid out
REF_NAME = "ctg"


def _tiles(spark, sf):
    return A.tiles_from_contigs(S.standin(spark, sf, "contigs"), ATILE, ATILE_OVERLAP, reference=REF_NAME)


def _reads(spark, sf, columns=None):
    """The reads as a written table, as a job has them: the mapping reads them in several branches. With ``columns``
    those beside the sequence that a query uses, as all columns of a written table are written."""
    reads = S.standin(spark, sf, "reads")
    return staged(reads if columns is None else reads.select("read_id", *columns, "seq"), "reads")


def _alignments(spark, sf, columns=None):
    reads = _reads(spark, sf, columns)
    return A.align_reads(reads, _tiles(spark, sf), K, MAX_OCC, MAX_MM, ATILE, references=[REF_NAME])


def _alignments_table(spark, sf):
    """The alignments materialised once (in the shared folder), as the job's
    written stage table is, for queries that read them in more than one branch."""
    return staged(_alignments(spark, sf), "alignments")


def q_kmer_index(spark, sf):
    idx = A.kmer_index(_tiles(spark, sf), K, MAX_OCC, ATILE)
    return idx.groupBy("contig_idx").agg(F.count("*").alias("n_kmers"), F.sum("pos").alias("sum_pos"),
                                         F.count("occ").alias("n_frequent"), F.coalesce(F.sum("occ"), F.lit(0)).alias("sum_occ"))


def q_map_reads(spark, sf):
    """A2: every read, also those that only frequent seeds place (``repeat``: several places are as good)."""
    return A.map_reads(_reads(spark, sf), _tiles(spark, sf), K, MAX_OCC, MAX_MM, ATILE, references=[REF_NAME]).select(
        "read_id", "contig_idx", "start", "strand", "votes", "second_votes", "mapq", "repeat")


def q_map_repeats(spark, sf):
    """A2 on a reference half of whose contigs hold everything twice: no rare seeds there."""
    twice = F.when(F.col("contig_idx") % 2 == 0, F.concat("seq", "seq")).otherwise(F.col("seq"))
    tiles = A.tiles_from_contigs(S.standin(spark, sf, "contigs").withColumn("seq", twice), ATILE, ATILE_OVERLAP, reference=REF_NAME)
    return A.map_reads(_reads(spark, sf), tiles, K, MAX_OCC, MAX_MM, ATILE, references=[REF_NAME]).select(
        "read_id", "contig_idx", "start", "strand", "votes", "second_votes", "mapq", "repeat")


def q_verify_hits(spark, sf):
    a = _alignments(spark, sf)
    correct = ((F.col("contig_idx") == F.col("true_contig_idx")) & (F.col("pos") == F.col("true_pos"))
               & (F.col("strand") == F.col("true_strand")))
    return a.select("read_id", "contig_idx", "pos", "strand", "flag", "cigar", "nm", "mapq", "repeat",
                    F.coalesce(correct, F.lit(False)).alias("correct"))


def q_sorted_alignments(spark, sf):
    """A4: the position of every row in the range-partitioned, sorted output."""
    srt = A.sort_alignments(_alignments(spark, sf, ())).withColumn("_mid", F.monotonically_increasing_id())
    return global_rank(srt.select("read_id", "contig_idx", "pos", "_mid"), ["_mid"], "sort_rank").select("read_id", "sort_rank", "contig_idx", "pos")


def q_merged_runs(spark, sf):
    m = A.merge_runs(_alignments(spark, sf, ("run_id", "sample_id")))
    return m.groupBy("sample_id", "reference").agg(
        F.count("*").alias("n_reads"), F.count_distinct("read_group").alias("n_read_groups"),
        F.count("pos").alias("n_mapped"), F.min("pos").alias("min_pos"), F.max("pos").alias("max_pos"))


def q_regions(spark, sf):
    t = A.tile_regions(_alignments(spark, sf, ()).where(F.col("pos").isNotNull()), 50)
    return t.groupBy("contig_idx", "region").agg(F.count("*").alias("n_reads"))


def q_region_merge(spark, sf):
    """Alignments laid out by region and merged from the parts: the place of every row in the merged set."""
    at = staging_dir(spark, "regions")
    A.write_regions(_alignments(spark, sf), at, 50)
    return A.merge_region_parts(spark, at).select("read_id", "row_number", "contig_idx", "pos")


def q_window_index(spark, sf):
    return A.index_alignments(_alignments(spark, sf, ()), 64).select(
        "contig_idx", "window", "n_reads", "min_pos", "max_pos", "max_end")


def q_region_query(spark, sf):
    """Alignments laid out by window, looked up through the index."""
    at = staging_dir(spark, "windows")
    aln = _alignments(spark, sf)
    A.write_windows(aln, at, 64, rounds=LAYOUT_ROUNDS if aln.count() > A.FEW else 1)
    laid = A.scan_windows(spark, at)
    return A.query_region(laid, A.index_alignments(laid, 64), "ctg3", 100, 130, 64).select("read_id", "pos")


def _regions_of_interest(spark, sf):
    c = S.standin(spark, sf, "contigs")
    a = c.select("contig", F.lit(110).cast("long").alias("start"), F.lit(130).cast("long").alias("end"))
    b = c.select("contig", F.lit(200).cast("long").alias("start"), F.length("seq").cast("long").alias("end"))
    return a.unionByName(b)


def q_overlap(spark, sf):
    a = (_alignments(spark, sf, ()).where(F.col("pos").isNotNull())
         .select("read_id", "contig", F.col("pos").alias("start"), (F.col("pos") + F.length("seq") - 1).alias("end")))
    j = A.overlap_join(a, _regions_of_interest(spark, sf), bin_size=32)
    return j.select(F.col("l_read_id").alias("read_id"), F.col("r_contig").alias("contig"),
                    F.col("r_start").alias("region_start"), F.col("r_end").alias("region_end"))


# ---------------------------------------------------------------- variants

MIN_DEPTH = 4


def q_pileup(spark, sf):
    return V.pileup(_alignments(spark, sf)).select(
        "sample_id", "contig_idx", "pos", "ref", "base", "n", "n_fwd", "n_rev", "qual_sum")


def _calls(spark, sf):
    return V.call_variants(_alignments_table(spark, sf), MIN_DEPTH)


def q_genotypes_pileup(spark, sf):
    """V2 through the full pileup (same answer as ``genotypes``)."""
    return V.call_genotypes(V.pileup(_alignments(spark, sf)), MIN_DEPTH).select(
        "sample_id", "contig", "pos", "ref", "alt", "depth", "ref_count", "alt_count", "genotype")


def q_genotypes(spark, sf):
    return _calls(spark, sf).select("sample_id", "contig", "pos", "ref", "alt", "depth", "ref_count", "alt_count", "genotype")


VCF_PART_ROWS = 2   # so that samples have several parts in the check


def _written_vcf(spark, sf):
    out = staging_dir(spark, "vcf")
    V.write_vcf(cut_lineage(_calls(spark, sf)), out, part_rows=VCF_PART_ROWS)
    return out


def q_vcf_roundtrip(spark, sf):
    rows = V.scan_vcf(spark, _written_vcf(spark, sf))
    return rows.select(F.col("call_name").alias("sample_id"), F.col("chrom").alias("contig"), "pos", "ref",
                       F.element_at("alts", 1).alias("alt"), F.col("gt").alias("genotype"), F.col("dp").alias("depth"))


def q_variants_flat(spark, sf):
    v = V.variants_table(V.scan_vcf(spark, _written_vcf(spark, sf)))
    return V.flatten_variants(v)


# ---------------------------------------------------------------- jobs and streams


def q_exported_rows(spark, sf):
    """V3-V6: half of the samples' files exported with half of their calls, then all files with all calls: the
    table holds every variant once, the first calls of the samples that were called again being replaced."""
    cfg = _job_config(spark, "export")
    calls = cut_lineage(_calls(spark, sf))
    half = F.substring("sample_id", 4, 20).cast("bigint") % 2 == 0
    for part in (calls.where(half & (F.col("contig_idx") % 2 == 0)), calls):
        V.write_vcf(part, cfg.path("vcf"))
        J.export_vcf(spark, cfg)
    table = J.exported_variants(spark, cfg)
    return V.flatten_variants(table.where(F.col("table_name") == f"variants_{REF_NAME}"))


def _job_config(spark, tag):
    return J.JobConfig(output_root=staging_dir(spark, tag), known_platforms=KNOWN_PLATFORMS, references=[REF_NAME],
                       fastq_root=SRC_ROOT, k=K, max_occ=MAX_OCC, max_mm=MAX_MM, tile=ATILE, tile_overlap=ATILE_OVERLAP,
                       min_depth=MIN_DEPTH, with_variant_calling=True, with_export=True, sample_buckets=8,
                       run_ts="run-0001", read_cells=16)


def _job_inputs(spark, sf, reads=None):
    return J.JobInputs(manifest=S.standin(spark, sf, "manifest").withColumnRenamed("n", "manifest_row"),
                       objects=S.standin(spark, sf, "objects"), reads=_reads(spark, sf) if reads is None else reads,
                       tiles=_tiles(spark, sf))


def q_job_completion(spark, sf):
    """The whole job over the stand-ins (reconcile, align, sort, merge,
    index, call, VCF, export), then the completion report of its outputs."""
    cfg = _job_config(spark, "job")
    J.run_job(spark, cfg, _job_inputs(spark, sf), stop_after="variants")
    return J.finalise(spark, cfg, "completion").select(
        "sample_id", "reference", F.col("n_runs").cast("bigint").alias("n_runs"),
        F.col("n_aligned").cast("bigint").alias("n_aligned"), F.col("n_sorted").cast("bigint").alias("n_sorted"),
        F.col("merged").cast("boolean").alias("merged"), F.col("indexed").cast("boolean").alias("indexed"),
        F.col("called").cast("boolean").alias("called"), F.col("complete").cast("boolean").alias("complete"))


def q_finalise_modes(spark, sf):
    """A whole job, some units of every stage taken back, every mode run again: the units done per mode, and
    what the tables hold per sample in the end."""
    cfg, inputs = _job_config(spark, "finalise"), _job_inputs(spark, sf)
    J.run_job(spark, cfg, inputs)
    for stage in J.STAGES:
        units = J.present_units(spark, cfg, stage).select("unit", "reference")
        J.forget_units(spark, cfg, stage, units.where(F.regexp_extract("unit", "([0-9]+)$", 1).cast("bigint") % 5 == 0))
    for mode in J.FINALISE_MODES[:-2]:
        J.finalise(spark, cfg, mode, inputs)
    J.finalise(spark, cfg, "export")
    reads = J.stage_table(spark, cfg, "merge").groupBy("sample_id").agg(
        F.count("*").alias("n_reads"), F.count_distinct("run_id").alias("n_runs"), F.count("pos").alias("n_mapped"))
    windows = J.stage_table(spark, cfg, "index").groupBy("sample_id").agg(F.sum("n_reads").alias("n_indexed"))
    calls = V.flatten_variants(J.exported_variants(spark, cfg)).groupBy(F.col("call_set_name").alias("sample_id")).agg(
        F.count("*").alias("n_exported"))
    zero = F.lit(0).cast("bigint")
    return reads.join(windows, "sample_id", "left").join(calls, "sample_id", "left").select(
        "sample_id", "n_reads", "n_runs", "n_mapped", F.coalesce("n_indexed", zero).alias("n_indexed"),
        F.coalesce("n_exported", zero).alias("n_exported"))


CHUNK_BYTES, CHUNK_RECORDS = 100, 2


def q_job_reads(spark, sf):
    """F2 and F3 inside the job: the reads table of all valid runs, per run, chunk and pair status."""
    mates = S.standin(spark, sf, "read_mates")
    reads = mates.withColumn("read_id", F.concat_ws("/", "run_id", F.col("mate").cast("string"), F.col("ordinal").cast("string")))
    cfg, inputs = _job_config(spark, "job-reads"), _job_inputs(spark, sf, reads)
    cfg.chunk_bytes, cfg.chunk_records = CHUNK_BYTES, CHUNK_RECORDS
    J.run_job(spark, cfg, inputs, stop_after="reconcile")
    J.load_reads(spark, cfg, J.pending_units(spark, cfg, "align").select("unit").distinct(), inputs)
    digest = F.md5(F.concat_ws("/", "read_id", "seq", "qual").cast("binary"))
    return J.stage_table(spark, cfg, J.READS).groupBy("run_id", "sample_id", "chunk", "pair_status").agg(
        F.count("*").alias("n_reads"), F.sum(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")).alias("content"))


def q_manifest_stream(spark, sf):
    """Streaming reconciliation: manifests dropped as files, processed by an
    availableNow stream, statuses read back from the idempotent sink."""
    m = S.standin(spark, sf, "manifest")
    drop = staging_dir(spark, "manifest-drop")
    cols = [F.col("run_id").alias("Run"), F.col("sample_id").alias("SRA_Sample"), F.col("study_id").alias("SRA_Study"),
            F.col("layout").alias("LibraryLayout"), F.col("platform").alias("Platform"),
            F.col("center_name").alias("Center_Name")]
    m.where(F.col("n") % 3 == 0).select(*cols).write.option("header", True).csv(f"{drop}/a")
    m.where(F.col("n") % 3 != 0).select(*cols).write.option("header", True).option("sep", "\t").csv(f"{drop}/b")
    out = staging_dir(spark, "manifest-stream-out")
    q = start_manifest_stream(spark, f"{drop}/*", S.standin(spark, sf, "objects"), KNOWN_PLATFORMS, SRC_ROOT, out,
                              checkpoint=staging_dir(spark, "manifest-stream-ckpt"))
    q.awaitTermination()
    return _status_cols(spark.read.parquet(out))


def _with_defaults(fn):
    """Queries run in whatever session the caller built: apply the SQL settings
    the plans rely on (explicit broadcasts only, fixed partition counts) first."""
    def run(spark, sf):
        apply_sql_defaults(spark)
        ship_package(spark)
        return fn(spark, sf)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES = {
    "manifest_scan": q_manifest_scan,
    "manifest_quarantine": q_manifest_quarantine,
    "manifest_required": q_manifest_required,
    "filter_samples": q_filter_samples,
    "expected_files": q_expected_files,
    "group_by_sample": q_group_by_sample,
    "references_json": q_references_json,
    "parse_objects": q_parse_objects,
    "match_prefix": q_match_prefix,
    "match_exact": q_match_exact,
    "file_exists": q_file_exists,
    "run_status": q_run_status,
    "run_status_exact": q_run_status_exact,
    "mate_order": q_mate_order,
    "repair_mate2": q_repair_mate2,
    "anomaly_lines": q_anomaly_lines,
    "anomaly_audit": q_anomaly_audit,
    "run_status_counts": q_run_status_counts,
    "pending_align": q_pending_align,
    "pending_sort": q_pending_sort,
    "pending_merge": q_pending_merge,
    "pending_index": q_pending_index,
    "pending_dv": q_pending_dv,
    "completion": q_completion,
    "completion_csv": q_completion_csv,
    "vcf_batches": q_vcf_batches,
    "export_ledger": q_export_ledger,
    "fastq_scan": q_fastq_scan,
    "fastq_gz_scan": q_fastq_gz_scan,
    "fastq_malformed": q_fastq_malformed,
    "mate_pairs": q_mate_pairs,
    "read_chunks": q_read_chunks,
    "fasta_scan": q_fasta_scan,
    "fasta_gz_scan": q_fasta_gz_scan,
    "fasta_index": q_fasta_index,
    "kmer_index": q_kmer_index,
    "map_reads": q_map_reads,
    "map_repeats": q_map_repeats,
    "verify_hits": q_verify_hits,
    "sorted_alignments": q_sorted_alignments,
    "merged_runs": q_merged_runs,
    "regions": q_regions,
    "region_merge": q_region_merge,
    "window_index": q_window_index,
    "region_query": q_region_query,
    "overlap": q_overlap,
    "pileup": q_pileup,
    "genotypes": q_genotypes,
    "genotypes_pileup": q_genotypes_pileup,
    "vcf_roundtrip": q_vcf_roundtrip,
    "variants_flat": q_variants_flat,
    "exported_rows": q_exported_rows,
    "job_completion": q_job_completion,
    "finalise_modes": q_finalise_modes,
    "job_reads": q_job_reads,
    "manifest_stream": q_manifest_stream,
}
QUERIES = {name: _with_defaults(fn) for name, fn in QUERIES.items()}
