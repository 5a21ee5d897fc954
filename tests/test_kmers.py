"""K-mers cut in batches against brute force, and the filter of those that reads ask for."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helixframe import standins as S
from helixframe.functions import kmers as K
from helixframe.functions.seq import kmer_code
from helixframe.operators import align as A
from conftest import SF


def _revcomp(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


@pytest.mark.parametrize("piece", [1 << 20, 50])
def test_kmers_of_a_batch_equal_brute_force(monkeypatch, piece):
    monkeypatch.setattr(K, "PIECE", piece)
    rnd = random.Random(3)
    seqs = ["".join(rnd.choice("ACGTN" if rnd.random() < 0.1 else "ACGT") for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    seqs += [None, "é" * 20, "ACGTACGTACGTACGTACGTé" + "ACGT" * 9, "acgtACGTACGTACGTACGT"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(seqs))), pa.array(seqs)], names=["id", "seq"]).slice(2)
    for k in (1, 5, 15, 18, 19, 31):
        for stride, limit, both, first in ((1, None, True, None), (k, None, True, "G"), (1, 7, False, "A")):
            got = sorted((int(r) + 2, strand, int(p), int(c)) for rows, strand, places, codes in
                         K._cut(batch, ["id"], k, stride, limit, both, first, None) for r, p, c in zip(rows, places, codes, strict=True))
            want = []
            for i, s in list(enumerate(seqs))[2:]:
                for strand, t in ((0, s or ""), (1, _revcomp(s or "")))[:2 if both else 1]:
                    for j in range(0, min(max(len(t) - k + 1, 0), 1 << 30 if limit is None else limit), stride):
                        cut = t[j:j + k]
                        if set(cut) <= set("ACGT") and first in (None, cut[0]):
                            want.append((i, strand, j, int(cut.translate(str.maketrans("ACGT", "0123")), 10 if k <= 18 else 4)))
            assert got == sorted(want), (k, stride, limit, both, first)


def test_codes_are_those_of_the_column_expression(spark):
    reads = spark.createDataFrame([("a", "ACGTTGCAACGTCACGATGCTTCGTAGGCTCA"), ("b", None)], "read_id string, seq string")
    for k in (15, 21):
        rows = K.cut_kmers(reads, ["read_id"], k, "j").join(reads, "read_id").withColumn("want", kmer_code(F.expr(f"substring(seq, j + 1, {k})"), k))
        assert rows.count() == 32 - k + 1 and rows.where("code != want").count() == 0


def test_filter_keeps_all_codes_of_the_sequences_and_few_others(spark):
    rnd = np.random.default_rng(5)
    some, other = ([(i, "".join(rnd.choice(list("ACGT"), 64))) for i in range(40)] for _ in range(2))
    one, two = (spark.createDataFrame(rows, "read_id long, seq string") for rows in (some, other))
    keep = K.code_filter(one, 15, 4000, both=True)
    assert K.cut_kmers(one, ["read_id"], 15, "j", both=True, keep=keep).count() == 40 * 100
    assert K.cut_kmers(two, ["read_id"], 15, "j", both=True, keep=keep).count() < 400
    assert K.code_filter(one, 15, 1 << 40) is None


def test_kmers_that_no_read_asks_for_are_not_exchanged(spark, monkeypatch):
    rnd = random.Random(2)
    contigs = [(i, f"c{i}", "".join(rnd.choice("ACGT") for _ in range(300))) for i in range(20)]
    contigs.append((20, "c20", contigs[1][2][:200] * 2))
    tiles = A.tiles_from_contigs(spark.createDataFrame(contigs, "contig_idx long, contig string, seq string"), 100, 80, reference="g")
    changed = contigs[2][2][20:50] + "T" + contigs[2][2][51:84]
    reads = spark.createDataFrame([(1, contigs[0][2][5:69]), (2, _revcomp(contigs[1][2][100:164])), (3, changed), (4, "ACGT" * 16), (5, contigs[1][2][30:94])],
                                  "read_id long, seq string")

    def aligned():
        return sorted(map(str, A.align_reads(reads, tiles, 15, 1, 4, 100, references=["g"]).collect()))

    plain, sizes, kmer_index = aligned(), [], A.kmer_index

    def counted(*args, **kwargs):
        index = kmer_index(*args, **kwargs)
        sizes.append(index.count())
        return index

    monkeypatch.setattr(A, "FILTERED", 0)
    monkeypatch.setattr(A, "kmer_index", counted)
    assert aligned() == plain
    # 5 reads of 8 sparse seeds each, then the lost ones with 100 seeds: of about 6,000 k-mers few are left
    assert len(sizes) == 2 and sizes[0] < 100 and sizes[1] < 1000
    assert kmer_index(tiles, 15, 1, 100).count() > 5000


def test_tiles_are_made_once_and_by_several_tasks(spark, monkeypatch):
    """A file of parts that one task reads is spread before its contigs are made, and the mapping reads written tiles."""
    assert S.standin(spark, SF, "contigs").rdd.getNumPartitions() > 1
    made, staged = [], A.staged
    monkeypatch.setattr(A, "staged", lambda df, purpose: made.append(purpose) or staged(df, purpose))
    contigs = S.standin(spark, SF, "contigs")
    reads = S.standin(spark, SF, "reads").select("read_id", "seq")
    aln = A.align_reads(reads, A.tiles_from_contigs(contigs, 100, 80, reference="ctg"), 15, 1, 4, 100, references=["ctg"])
    assert made.count("tiles") == 1 and aln.where("pos IS NULL").count() == 0
