"""Alignment, overlap join, pileup and calls against brute force on small inputs."""

import random

from pyspark.sql import functions as F

from helixframe.functions.rank import global_rank
from helixframe.operators import align as A
from helixframe.operators import variants as V

random.seed(7)
GENOME = {f"c{i}": "".join(random.choice("ACGT") for _ in range(400)) for i in range(3)}


def _revcomp(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def _setup(spark):
    contigs = spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(GENOME.items())],
                                    "contig_idx long, contig string, seq string")
    tiles = A.tiles_from_contigs(contigs, tile=128, overlap=100, reference="g")
    reads, truth = [], {}
    rid = 0
    for ci, (name, s) in enumerate(GENOME.items()):
        for start in range(0, 330, 11):
            frag = s[start:start + 50]
            if rid % 5 == 0:                       # one substitution
                frag = frag[:20] + ("A" if frag[20] != "A" else "C") + frag[21:]
            strand = rid % 2
            reads.append((rid, "S1", "R1", _revcomp(frag) if strand else frag, "I" * 50))
            truth[rid] = (ci, start + 1, strand)
            rid += 1
    rdf = spark.createDataFrame(reads, "read_id long, sample_id string, run_id string, seq string, qual string")
    return tiles, rdf, truth


def test_mapping_recovers_truth(spark):
    tiles, reads, truth = _setup(spark)
    aln = A.align_reads(reads, tiles, k=11, max_occ=8, max_mm=2, tile=128).collect()
    assert len(aln) == len(truth)
    for r in aln:
        assert (r.contig_idx, r.pos, r.strand) == truth[r.read_id]
        assert r.cigar == "50M" and r.nm in (0, 1) and r.flag in (0, 16)


def test_sort_merge_index_region(spark):
    tiles, reads, truth = _setup(spark)
    aln = A.align_reads(reads, tiles, k=11, max_occ=8, max_mm=2, tile=128)
    srt = A.sort_alignments(aln, 4).withColumn("_m", F.monotonically_increasing_id())
    ranked = global_rank(srt, ["_m"]).orderBy("rank").collect()
    keys = [(r.contig_idx, r.pos, r.strand, r.read_id) for r in ranked]
    assert keys == sorted(keys)
    assert A.merge_runs(aln).count() == len(truth)
    idx = A.index_alignments(aln, 64)
    got = sorted(r.read_id for r in A.query_region(aln, idx, "c1", 100, 120, 64).collect())
    want = sorted(k for k, (c, p, _) in truth.items() if c == 1 and p <= 120 and p + 49 >= 100)
    assert got == want


def test_overlap_join_brute_force(spark):
    rnd = random.Random(3)
    left = [(i, "c", a, a + rnd.randint(0, 300)) for i, a in enumerate(rnd.randint(1, 2000) for _ in range(150))]
    right = [(j, "c", b, b + rnd.randint(0, 50)) for j, b in enumerate(rnd.randint(1, 2000) for _ in range(80))]
    l_df = spark.createDataFrame(left, "id long, contig string, start long, end long")
    r_df = spark.createDataFrame(right, "id long, contig string, start long, end long")
    got = sorted((r.l_id, r.r_id) for r in A.overlap_join(l_df, r_df, bin_size=64).collect())
    want = sorted((a[0], b[0]) for a in left for b in right if a[2] <= b[3] and b[2] <= a[3])
    assert got == want


def test_pileup_and_genotype_rule(spark):
    rows = []
    for i in range(10):
        base = "T" if i < 9 else "A"             # 9 of 10 reads carry T at position 3
        rows.append((i, "S", "g", 0, "c0", 1, 0 if i % 2 else 1, "AC" + base + "GT", "IIIII", "ACAGT"))
    aln = spark.createDataFrame(rows, "read_id long, sample_id string, reference string, contig_idx long, "
                                      "contig string, pos long, strand int, seq string, qual string, ref_seq string")
    pu = V.pileup(aln)
    site = {(r.pos, r.base): r for r in pu.collect()}
    assert site[(3, "T")].n == 9 and site[(3, "A")].n == 1 and site[(3, "T")].qual_sum == 9 * 40
    calls = V.call_genotypes(pu, 4).collect()
    assert [(c.pos, c.ref, c.alt, c.genotype, c.depth, c.alt_count) for c in calls] == [(3, "A", "T", "1/1", 10, 9)]


def test_vcf_round_trip(spark, tmp_path):
    calls = spark.createDataFrame(
        [("S1", "g", 0, "c0", 5, "A", "T", 10, 5, 5, "0/1"), ("S2", "g", 0, "c0", 7, "G", "C", 9, 0, 9, "1/1")],
        "sample_id string, reference string, contig_idx long, contig string, pos long, ref string, alt string, "
        "depth long, ref_count long, alt_count long, genotype string")
    V.write_vcf(calls, str(tmp_path / "vcf"))
    files = list((tmp_path / "vcf").rglob("part-*"))
    assert len(files) == 2 and all("sample_id=S" in str(f) for f in files)
    first = files[0].read_text().splitlines()
    assert first[0] == "##fileformat=VCFv4.2" and first[1].startswith("#CHROM")
    rows = V.scan_vcf(spark, str(tmp_path / "vcf"))
    got = sorted((r.call_name, r.pos, r.ref, r.alts[0], r.gt, list(r.genotype)) for r in rows.collect())
    assert got == [("S1", 5, "A", "T", "0/1", [0, 1]), ("S2", 7, "G", "C", "1/1", [1, 1])]
    flat = V.flatten_variants(V.variants_table(rows)).collect()
    assert sorted((f.start, f.end, f.call_set_name, f.genotype) for f in flat) == [(4, 5, "S1", "0/1"), (6, 7, "S2", "1/1")]


def test_sparse_calls_equal_pileup_calls(spark):
    tiles, reads, _ = _setup(spark)
    aln = A.align_reads(reads, tiles, k=11, max_occ=8, max_mm=2, tile=128)
    cols = ["sample_id", "contig", "pos", "ref", "alt", "depth", "ref_count", "alt_count", "genotype"]
    full = sorted(tuple(r) for r in V.call_genotypes(V.pileup(aln), 2).select(*cols).collect())
    sparse = sorted(tuple(r) for r in V.call_variants(aln, 2, block=64).select(*cols).collect())
    assert full == sparse and len(full) > 0


def test_reads_of_any_length(spark):
    tiles, _, _ = _setup(spark)
    g = GENOME["c1"]
    rows = [(1, g[3:390]), (2, g[100:111]), (3, "ACGTA"), (4, ""), (5, _revcomp(g[20:320])), (6, "N" * 40), (7, g[350:] + "ACGT" * 9)]
    reads = spark.createDataFrame([(i, "S", "R", s, "I" * len(s)) for i, s in rows],
                                  "read_id long, sample_id string, run_id string, seq string, qual string")
    got = {r.read_id: (r.contig_idx, r.pos, r.strand, r.nm) for r in A.align_reads(reads, tiles, k=11, max_mm=2, tile=128).collect()}
    assert got == {1: (1, 4, 0, 0), 2: (1, 101, 0, 0), 5: (1, 21, 1, 0), **dict.fromkeys((3, 4, 6, 7), (None,) * 4)}


def _hamming(a, b):
    return sum(x != y for x, y in zip(a, b, strict=True))


def _places(read, contigs, k, max_mm):
    """All (nm, contig, start, strand) within ``max_mm`` mismatches that share an intact k-mer with the read."""
    out = set()
    for strand, s in ((0, read), (1, _revcomp(read))):
        for c, g in enumerate(contigs):
            for start in range(len(g) - len(s) + 1):
                under = g[start:start + len(s)]
                if _hamming(s, under) <= max_mm and any(s[j:j + k] == under[j:j + k] for j in range(len(s) - k + 1)):
                    out.add((_hamming(s, under), c, start, strand))
    return out


def test_every_read_with_an_intact_seed_is_placed_whatever_is_frequent(spark):
    """Repeats: exact copies, copies that differ a little, and reads shorter and longer than a seed or a tile."""
    rnd = random.Random(11)

    def dna(n):
        return "".join(rnd.choice("ACGT") for _ in range(n))

    def changed(s, *at):
        return "".join(("A" if c != "A" else "G") if i in at else c for i, c in enumerate(s))

    unit = dna(150)
    contigs = [dna(30) + unit + dna(20) + unit, unit, dna(40) + changed(unit, 40, 90) + dna(10), dna(200), unit * 3]
    reads = {1: unit[5:69], 2: changed(unit[5:69], 30), 3: changed(unit[10:74], 20, 50), 4: unit[60:90], 5: _revcomp(changed(unit[3:67], 1, 40)),
             6: changed(unit, 40, 90)[20:110], 7: contigs[3][50:114], 8: changed(contigs[3][60:130], 14, 29, 44), 9: dna(64), 10: unit + unit[:40],
             11: contigs[0][10:70], 12: contigs[0][-40:], 13: unit[:15], 14: "N" * 20 + unit[20:60], 15: unit[1:65]}
    frame = spark.createDataFrame([(i, f"c{i}", s) for i, s in enumerate(contigs)], "contig_idx long, contig string, seq string")
    tiles = A.tiles_from_contigs(frame, tile=64, overlap=40, reference="g")
    rows = spark.createDataFrame([(i, "S", "R", s, "I" * len(s)) for i, s in reads.items()],
                                 "read_id long, sample_id string, run_id string, seq string, qual string")
    near = {i: _places(s, contigs, 15, 4) for i, s in reads.items()}
    assert [i for i, found in near.items() if not found] == [9, 14]
    for max_occ in (1, 7):
        aln = {r.read_id: r for r in A.align_reads(rows, tiles, 15, max_occ, 4, 64, class_factor=2).collect()}
        assert set(aln) == set(reads)
        for i, r in aln.items():
            if not near[i]:
                assert (r.flag, r.repeat) == (4, False)
                continue
            assert (r.nm, r.contig_idx, r.pos - 1, r.strand) in near[i], (max_occ, i)
            same = [p for p in near[i] if p[0] == r.nm]
            if max_occ == 1:          # these repeats hold no rare seed
                assert r.repeat == (len(same) > 1) and (r.mapq == 0) == (len(same) > 1), i
            assert not r.repeat or len(same) > 1
    # the placed rows say how: votes of rare seeds, or none
    hits = {r.read_id: r for r in A.map_reads(rows, tiles, 15, 1, 4, 64).collect()}
    assert hits[7].votes > 1 and not hits[7].repeat and hits[2].votes == 0 and hits[2].repeat and hits[9].start is None


def test_index_counts_and_frequent_seeds(spark):
    rnd = random.Random(5)
    unit, *tails = ["".join(rnd.choice("ACGT") for _ in range(n)) for n in [20] + [80] * 12]
    contigs = spark.createDataFrame([(i, f"c{i}", unit + t) for i, t in enumerate(tails)], "contig_idx long, contig string, seq string")
    index = A.kmer_index(A.tiles_from_contigs(contigs, tile=64, overlap=40, reference="g"), 15, 4, 64)
    assert index.select("contig_idx", "pos").distinct().count() == index.count() == 12 * 86   # no position is dropped
    occ = sorted(r.occ for r in A.seed_frequencies(index).collect())
    assert occ[-6:] == [12] * 6 and occ[0] > 4


def test_a_hot_seed_is_joined_by_distinct_surroundings_under_salted_keys(spark):
    """100 copies of a unit: what meets the reads is one text per distinct surrounding, not one per copy."""
    rnd = random.Random(1)
    unit = "".join(rnd.choice("ACGT") for _ in range(60))
    contigs = spark.createDataFrame([(0, "c0", unit * 100)], "contig_idx long, contig string, seq string")
    tiles = A.tiles_from_contigs(contigs, tile=512, overlap=40, reference="g")
    index = A.kmer_index(tiles, 15, 4, 512)
    texts = A.surroundings(index, tiles, 40, 15, 512)
    assert texts.agg(F.sum("copies")).first()[0] == 6000 - 14 and texts.count() < 60 + 2 * 40


def test_unknown_bases_are_no_evidence(spark):
    rows = [(i, "S", "g", 0, "c0", 1, 0, s, "IIIII", "ACNGT") for i, s in enumerate(["ANTGT", "ANTGT", "ACTTT", "ACTTT", "ACTTT"])]
    aln = spark.createDataFrame(rows, "read_id long, sample_id string, reference string, contig_idx long, "
                                      "contig string, pos long, strand int, seq string, qual string, ref_seq string")
    cols = ["pos", "ref", "alt", "depth", "ref_count", "alt_count", "genotype"]
    want = [(4, "G", "T", 5, 2, 3, "0/1")]
    assert [tuple(r) for r in V.call_variants(aln, 2).select(*cols).collect()] == want
    assert [tuple(r) for r in V.call_genotypes(V.pileup(aln), 2).select(*cols).collect()] == want


def test_no_exchange_moves_tiles_by_read(spark):
    tiles, reads, _ = _setup(spark)
    plan = A.align_reads(reads, tiles, k=11, max_mm=2, tile=128)._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("\n"):
        assert not ("hashpartitioning(read_id" in line and "tile_seq" in line)


def _many_calls(spark, n):
    """``n`` calls of one sample on two contigs, three of another."""
    hot = spark.range(n).select(F.lit("hot").alias("sample_id"), (F.col("id") % 2).alias("contig_idx"), (F.col("id") * 7919 % 100_003 + 1).alias("pos"))
    few = spark.range(3).select(F.lit("few").alias("sample_id"), F.lit(0).cast("long").alias("contig_idx"), (F.col("id") + 1).alias("pos"))
    return hot.unionByName(few).select(
        "sample_id", F.lit("g").alias("reference"), "contig_idx", F.concat(F.lit("c"), F.col("contig_idx").cast("string")).alias("contig"), "pos",
        F.lit("A").alias("ref"), F.lit("C").alias("alt"), F.lit(5).cast("long").alias("depth"), F.lit(0).cast("long").alias("ref_count"),
        F.lit(5).cast("long").alias("alt_count"), F.lit("1/1").alias("genotype"))


def test_vcf_of_a_large_sample_is_written_by_several_tasks_in_order(spark, tmp_path):
    calls, at = _many_calls(spark, 4000), str(tmp_path / "vcf")
    none = spark.createDataFrame([("g", "none")], "reference string, sample_id string")
    V.write_vcf(calls, at, none, part_rows=500)

    def parts(sample):
        folder = tmp_path / "vcf" / "reference=g" / f"sample_id={sample}"
        return [p.read_text().splitlines() for p in sorted(folder.glob("part-*"))]

    hot = parts("hot")
    assert len(hot) >= 3 and len(parts("few")) == 1
    lines = [line for part in hot for line in part]
    assert lines[0] == V.VCF_HEADER and lines[1] == V.VCF_COLUMNS + "\thot" and len(lines) == 4002
    where = [(line.split("\t")[0], int(line.split("\t")[1])) for line in lines[2:]]
    assert where == sorted(where)
    assert [line for part in parts("none") for line in part] == [V.VCF_HEADER, V.VCF_COLUMNS + "\tnone"]
    got = V.scan_vcf(spark, at).select("call_name", "chrom", "pos", "ref", F.element_at("alts", 1), "gt", "dp")
    want = calls.select("sample_id", "contig", "pos", "ref", "alt", "genotype", "depth")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # one sample again, with fewer calls: its parts are all replaced, the others stay
    V.write_vcf(_many_calls(spark, 10).where("sample_id = 'hot'"), at, keep_others=True)
    assert len(parts("hot")) == 1
    assert {r.call_name: r["count"] for r in V.scan_vcf(spark, at).groupBy("call_name").count().collect()} == {"hot": 10, "few": 3}


def test_every_file_of_a_folder_keeps_its_own_header(spark, tmp_path):
    def text(names, *positions):
        rows = ["\t".join(["c0", str(p), ".", "A", "C", ".", "PASS", ".", "GT", *["0/1"] * len(names)]) for p in positions]
        return "\n".join([V.VCF_HEADER, V.VCF_COLUMNS + "\t" + "\t".join(names), *rows]) + "\n"
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "a.vcf").write_text(text(["x", "y"], 1))
    (tmp_path / "v" / "b.vcf").write_text(text(["z"], 2))
    (tmp_path / "v" / "b2.vcf").write_text("\n".join(text(["z"], 3).splitlines()[2:]) + "\n")     # a later part of b
    got = V.scan_vcf(spark, str(tmp_path / "v")).select("call_name", "pos").collect()
    assert sorted(map(tuple, got)) == [("x", 1), ("y", 1), ("z", 2), ("z", 3)]


def _placed(spark, n):
    """``n`` alignments of three samples, half of them in one region, some unmapped."""
    lost = F.col("id") % 17 == 0
    return spark.range(n).repartition(5).select(
        F.concat(F.lit("r"), F.col("id")).alias("read_id"), F.concat(F.lit("S"), F.col("id") % 3).alias("sample_id"), F.lit("R1").alias("run_id"),
        F.when(F.col("id") % 2 == 0, "g").otherwise("h").alias("reference"),
        F.when(~lost, F.col("id") % 4).alias("contig_idx"),
        F.when(~lost, F.when(F.col("id") % 4 < 2, F.col("id") % 10).otherwise(F.col("id") * 31 % 5000) + 1).alias("pos"),
        F.when(~lost, F.col("id") % 2).cast("int").alias("strand"))


def test_regions_are_merged_by_their_parts_without_a_second_sort(spark, tmp_path):
    aln = _placed(spark, 3000)
    for folders in ((), ("reference", "bucket")):
        rows, at = aln.withColumn("bucket", F.col("sample_id")), str(tmp_path / f"r{len(folders)}")
        A.write_regions(rows, at, 100, folders, num_partitions=6)
        got = A.merge_region_parts(spark, at, folders, num_partitions=3)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and plan.count("Exchange ") <= 3
        by = [F.col("bucket")] if folders else []
        want = rows.orderBy("reference", *by, F.col("contig_idx").asc_nulls_last(), F.col("pos").asc_nulls_last(), "strand", "read_id")
        assert [r.read_id for r in got.collect()] == [r.read_id for r in want.collect()]
        assert sorted(r.row_number for r in got.collect()) == list(range(1, 3001))
        # a region is read by its number alone, unmerged
        one = spark.read.parquet(at).where("reference = 'g' AND contig_idx = 2 AND region = 3")
        assert one.count() == aln.where("reference = 'g' AND contig_idx = 2 AND pos BETWEEN 301 AND 400").count() > 0
    A.write_regions(aln.limit(0), str(tmp_path / "none"), 100)
    assert A.merge_region_parts(spark, str(tmp_path / "none")).count() == 0
