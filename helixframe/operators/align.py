"""Alignment tables: seed-and-vote mapping, verification, sorting, merging,
region tiling, window index and interval overlap joins (A1-A8).

The aligner, BAM and BAI bodies are outside the reference tree; this module is
their table-level re-aim with its own contract:

* A1 ``kmer_index``: every k-mer of the reference with its 0-based position, and
  ``occ``, how often it occurs, where that is more than ``max_occ``.  No position
  is dropped.  ``seed_frequencies`` is the table of the frequent ones.
* A2 ``map_reads``: rarest seeds first.  Round 0: seeds at offsets 0, k, 2k, … of
  both strands that are rare in the reference vote per (read, reference, contig,
  strand, diagonal = ref_pos − read_offset); the most votes win, ties broken by
  contig, start, strand.  Reads that this does not place within ``max_mm``
  mismatches go on to their seeds at *every* offset, the rare ones first, then
  class by class of frequency.  So a read that has an intact k-mer and at most
  ``max_mm`` mismatches somewhere is placed, whatever ``max_occ`` is.
* A3 ``verify_hits``: ungapped comparison with the reference tile; hits with
  more than ``max_mm`` mismatches or off the contig become unmapped.

A frequent seed has no join of all its reads with all its copies: only reads that
no rarer seed placed meet it, as distinct sequences, and of its copies only the
distinct surroundings, under salted keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.functions import intervals as I
from helixframe.functions.joins import broadcast_if_small
from helixframe.functions.kmers import BITS_PER_CODE, code_filter, cut_kmers, filter_of_codes
from helixframe.functions.partitioning import spread
from helixframe.functions.seq import revcomp
from helixframe.session import cut_lineage, staged

UNMAPPED_FLAG, REVERSE_FLAG = 4, 16
WINDOW = 16384


def tiles_from_contigs(contigs: DataFrame, tile: int = 65536, overlap: int = 1024,
                       reference: str | None = None) -> DataFrame:
    """Tiles from (contig_idx, contig, seq) rows already in a table (F4 gives the
    same shape from FASTA files)."""
    n_tiles = F.floor((F.length("seq") - 1) / tile).cast("int")
    t = contigs.select("contig_idx", "contig", "seq", F.explode(F.sequence(F.lit(0), n_tiles)).alias("tile"))
    t = t.select("contig_idx", "contig", F.col("tile").cast("long").alias("tile"),
                 (F.col("tile") * tile).cast("long").alias("start"),
                 F.expr(f"substring(seq, tile * {tile} + 1, {tile + overlap})").alias("seq"),
                 F.length("seq").alias("contig_len"))
    if reference is not None:
        t = t.withColumn("reference", F.lit(reference))
    return t


# A class of seeds is this many times as frequent as the one before it, and a salted share of a seed's
# surroundings has about this many.
CLASS_FACTOR, SALTED = 64, 1024
# Keys of a seed, the telling one first: sorts compare it alone.
SEED = ("code", "reference")


# Seeds, or reads that were placed anew, whose table is broadcast.
FEW = 500_000
# K-mers above which they are exchanged in rounds, by the base that they begin with.
ROUND_BASES = 1 << 26
# Bases of the tiles above which the k-mers that no read asks for are filtered out before they are exchanged.
FILTERED = 1 << 23
BASES = ("A", "C", "G", "T")


def kmer_index(tiles: DataFrame, k: int = 15, max_occ: int = 64, tile: int = 65536, asked: DataFrame | None = None,
               first: str | None = None, keep=None, dealt: bool = False) -> DataFrame:
    """A1: (reference, code, contig_idx, pos, occ) for every k-mer position; ``occ`` is null up to ``max_occ``.

    With ``asked`` (reference, code) for every position of those k-mers alone. Few of them are broadcast, so that
    nothing else of the index is exchanged. With ``first`` for the k-mers that begin with that base. With ``keep``
    (``code_filter``) for every position of the k-mers in the filter and of few others. Tiles that are ``dealt`` lie
    in as many files as there are tasks; others are spread first, as they may be in a few."""
    ref = F.col("reference") if "reference" in tiles.columns else F.lit("ref")
    # k-mers that begin in a tile's own part: its overlap belongs to the next tile
    km = cut_kmers((tiles if dealt else spread(tiles)).withColumn("reference", ref), ["reference", "contig_idx", "start"], k, "i", limit=tile, first=first, keep=keep)
    km = km.select("reference", "contig_idx", (F.col("start") + F.col("i")).alias("pos"), "code")
    if asked is not None:
        km = km.join(broadcast_if_small(asked, FEW), list(SEED), "left_semi")
    # One exchange, which a join by ``SEED`` with the index goes on from: the rows of a k-mer are next to each other, and
    # a window counts them (a satellite k-mer seen millions of times goes through its buffer, which spills).
    occ = F.count(F.lit(1)).over(Window.partitionBy(*SEED))
    return km.withColumn("_n", occ).select("reference", "code", "contig_idx", "pos", F.when(
        (F.col("_n") > max_occ) & F.col("reference").isNotNull(), F.col("_n")).alias("occ"))


def _bases(tiles: DataFrame) -> int:
    return tiles.agg(F.sum(F.length("seq")).alias("n")).first()["n"] or 0


def _overlap(tiles: DataFrame, tile: int) -> int:
    """Bases by which every tile reaches into the next one, where its contig goes on."""
    goes_on = F.col("start") + F.length("seq") < F.col("contig_len")
    return max(0, tiles.agg(F.min(F.when(goes_on, F.length("seq") - tile)).alias("n")).first()["n"] or 0)


def _repeated(reads: DataFrame) -> bool:
    """Whether some read id comes more than once."""
    return bool(reads.groupBy("read_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1))


def _rounds(kmers: int) -> tuple:
    """The ``first`` of every round in which so many k-mers are exchanged: a single one for few.

    A k-mer and the seeds that meet it are in the same round, so rounds divide what lies on disk at a time, by about four."""
    return BASES if kmers > ROUND_BASES else (None,)


def _asked_filter(sequences: DataFrame, bases: int, k: int, stride: int) -> tuple:
    """A filter of the k-mers that the seeds of ``sequences`` ask for, where they are fewer than the ``bases`` of the
    reference and these are many: what no read asks for is neither exchanged nor sorted. Then about how many are."""
    if bases <= FILTERED:
        return None, bases
    windows = F.floor((F.length("seq") - k) / stride) + 1
    n = sequences.agg(F.sum(F.when(windows > 0, 2 * windows))).first()[0] or 0
    keep = code_filter(sequences, k, n, stride, both=True) if n < bases else None
    return keep, bases if keep is None else min(bases, n + bases // BITS_PER_CODE)


def _union(parts: list[DataFrame]) -> DataFrame:
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def _share(df: DataFrame, i: int, of: int) -> DataFrame:
    """The rows of the ``i``-th of ``of`` rounds; rows of one read are in the same round."""
    return df if of == 1 else df.where(F.pmod(F.xxhash64("read_id"), F.lit(of)) == i)


def seed_frequencies(index: DataFrame) -> DataFrame:
    """A1: (reference, code, occ) of the frequent k-mers."""
    return index.where("occ IS NOT NULL").groupBy("reference", "code").agg(F.max("occ").alias("occ"))


def read_kmers(reads: DataFrame, k: int = 15, stride: int | None = None, keys: tuple[str, ...] = ("read_id",),
               first: str | None = None, keep=None) -> DataFrame:
    """Both strands of each read cut into seed k-mers at offsets 0, stride, 2·stride, …
    (default stride = k: non-overlapping seeds), with ``first`` those that begin with that base.  A read shorter
    than k has no seed."""
    return cut_kmers(reads, list(keys), k, "j", stride or k, both=True, first=first, keep=keep)


def seed_hits(reads: DataFrame, index: DataFrame, k: int = 15, stride: int | None = None,
              references: list[str] | None = None, first: str | None = None) -> DataFrame:
    """A2, round 0: read_id, reference, contig_idx, strand, pos and j of every rare seed and its places; with ``first``
    of the seeds that begin with that base.  Sparse seeds, as probe volume is what grows with the read data; no key
    of this join has more than ``max_occ`` rows of the index.
    """
    km = read_kmers(reads, k, stride, first=first)
    keys = ["code"]
    if references:
        km = km.withColumn("reference", F.explode(F.array(*[F.lit(r) for r in references])))
        keys = list(SEED)
    return km.join(index.where("occ IS NULL").drop("occ"), keys).select("read_id", "reference", "contig_idx", "strand", "pos", "j")


def vote_hits(reads: DataFrame, index: DataFrame, k: int = 15, stride: int | None = None,
              references: list[str] | None = None) -> DataFrame:
    """A2, round 0: the place with the most votes of rare seeds, per read and reference.

    Returns read_id, reference, contig_idx, start (0-based), strand, votes, second_votes, mapq, repeat (another
    place has as many votes); reads without a rare seed are absent.
    """
    return best_votes(seed_hits(reads, index, k, stride, references))


def best_votes(hits: DataFrame) -> DataFrame:
    """The result of ``vote_hits`` from the rows of ``seed_hits``."""
    # All hits of a read in one exchange, for the grouping and the window that follow.
    hits = hits.repartition("read_id", "reference")
    votes = (hits.groupBy("read_id", "reference", "contig_idx", "strand", (F.col("pos") - F.col("j")).alias("start"))
             .agg(F.count("*").alias("votes")))
    # The first place of a read in the order of its votes and the votes of the one after it: one sort of the slim counts,
    # no list of candidates (a read with very many of them goes through the window's buffer, which spills).
    order = Window.partitionBy("read_id", "reference").orderBy(F.desc("votes"), "contig_idx", "start", "strand")
    best = votes.withColumns({"_n": F.row_number().over(order), "second_votes": F.lead("votes", 1, 0).over(order)}).where("_n = 1")
    return best.select(
        "read_id", "reference", "contig_idx", "start", "strand", "votes", "second_votes",
        F.floor(F.lit(60) * (F.col("votes") - F.col("second_votes")) / F.col("votes")).cast("int").alias("mapq"),
        (F.col("votes") == F.col("second_votes")).alias("repeat"))


def _wide(tiles: DataFrame, span: int, tile: int) -> DataFrame:
    """Tiles joined with their neighbours: ``_text`` holds ``span`` bases to both sides of every place of ``_tile``."""
    ref = F.col("reference") if "reference" in tiles.columns else F.lit("ref")
    reach = -(-span // tile)
    return (tiles.select(ref.alias("_reference"), F.col("contig_idx").alias("_contig"), "tile", "start", F.substring("seq", 1, tile).alias("own"),
                         F.explode(F.sequence(F.col("tile") - reach, F.col("tile") + reach)).alias("_tile"))
            .groupBy("_reference", "_contig", "_tile").agg(
                F.min("start").alias("_start"),
                F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("tile", "own"))), lambda x: x["own"]), "").alias("_text")))


def surroundings(places: DataFrame, tiles: DataFrame, span: int, k: int, tile: int) -> DataFrame:
    """(reference, code, contig_idx, pos) to the distinct texts around a seed, ``span - k`` bases to both sides:
    ``left`` (bases before the seed), ``around``, ``first`` (the first place that looks so) and ``copies``.

    Tiles are joined with their neighbours first, so that a text is cut out of one row."""
    met = places.join(_wide(tiles, span, tile), (F.col("reference") == F.col("_reference")) & (F.col("contig_idx") == F.col("_contig"))
                      & (F.floor(F.col("pos") / tile) == F.col("_tile")))
    left = F.least(F.col("pos") - F.col("_start"), F.lit(span - k))
    around = F.substring("_text", (F.col("pos") - F.col("_start") - left + 1).cast("int"), (left + span).cast("int"))
    return met.select("reference", "code", "contig_idx", "pos", left.cast("int").alias("left"), around.alias("around")).groupBy(
        "reference", "code", "left", "around").agg(F.min(F.struct("contig_idx", "pos")).alias("first"), F.count("*").alias("copies"))


def _by_place(seeds: DataFrame, places: DataFrame, sequences: DataFrame, wide: DataFrame, tile: int) -> DataFrame:
    """The sequences (``sid``) at every place that one of their ``seeds`` asks for, with ``nm``: rows of numbers until
    a place is there once, however many seeds of a sequence found it, and one comparison for it."""
    at = seeds.join(places, list(SEED)).select("sid", "contig_idx", (F.col("pos") - F.col("j")).alias("start"), "strand").where("start >= 0").distinct()
    met = at.join(sequences, "sid").join(wide, (F.col("reference") == F.col("_reference")) & (F.col("contig_idx") == F.col("_contig"))
                                         & (F.floor(F.col("start") / tile) == F.col("_tile")))
    read = F.when(F.col("strand") == 1, revcomp(F.col("seq"))).otherwise(F.col("seq"))
    under = F.substring("_text", (F.col("start") - F.col("_start") + 1).cast("int"), F.length("seq"))
    return met.where(F.length(under) == F.length("seq")).select("sid", _mismatches(read, under).alias("nm"), "contig_idx", "start", "strand",
                                                                F.lit(1).cast("long").alias("copies"))


def _by_text(seeds: DataFrame, places: DataFrame, sequences: DataFrame, tiles: DataFrame, span: int, k: int, tile: int, salts: int) -> DataFrame:
    """The same for seeds of very many copies: the distinct texts around a seed stand for its copies, under salted keys."""
    texts = surroundings(places.join(seeds.select(*SEED).distinct(), list(SEED), "left_semi"), tiles, span, k, tile)
    texts = texts.withColumn("salt", F.pmod(F.xxhash64("around"), F.lit(salts)))
    salted = seeds.join(sequences.select("sid", "seq"), "sid").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    met = salted.join(texts, [*SEED, "salt"])
    read = F.when(F.col("strand") == 1, revcomp(F.col("seq"))).otherwise(F.col("seq"))
    under = F.substring(F.col("around"), F.col("left") - F.col("j") + 1, F.length("seq"))
    fits = (F.col("left") >= F.col("j")) & (F.length("around") >= F.col("left") - F.col("j") + F.length("seq"))
    placed = met.where(fits).select("sid", _mismatches(read, under).alias("nm"), F.col("first.contig_idx").alias("contig_idx"),
                                    (F.col("first.pos") - F.col("j")).alias("start"), "strand", "copies")
    # A place is found by many seeds: one row each, before the best are counted.
    return placed.groupBy("sid", "nm", "contig_idx", "start", "strand").agg(F.max("copies").alias("copies"))


def rescue_reads(reads: DataFrame, index: DataFrame | None, tiles: DataFrame, k: int = 15, max_occ: int = 64, max_mm: int = 4,
                 tile: int = 65536, class_factor: int = CLASS_FACTOR, bases: int | None = None) -> DataFrame:
    """A2, further rounds, for (read_id, reference, seq) that votes did not place: seeds at every offset, by class of frequency.

    Class 0 are the rare seeds; class c those seen at most ``max_occ · class_factor^c`` times.  Of the places
    that a class gives, within ``max_mm`` mismatches, the fewest mismatches win, ties by contig, start and
    strand; the next class meets the reads that are left.  Returns read_id, reference, contig_idx, start,
    strand, votes (0), second_votes (0), mapq, repeat (several places are as good), written.
    Without an ``index`` the places of the seeds asked for are found in ``tiles`` (of so many ``bases``, if counted).
    """
    # Sequences go by a number: the rows of their seeds, a hundred or more each, do not carry them.
    sequences = staged(reads.select("reference", "seq").distinct().withColumn("sid", F.monotonically_increasing_id()), "lost-sequences")
    sizes = sequences.agg(F.max(F.length("seq")).alias("span"), F.sum(F.greatest(F.length("seq") - k + 1, F.lit(0)) * 2).alias("n")).first()
    span, n_seeds = sizes["span"] or 0, sizes["n"] or 0
    # The whole index is read once; the classes look at the places that some read's seeds ask for.
    if span >= k and (index is not None or n_seeds <= FEW):
        asked = staged(read_kmers(sequences, k, 1, ("reference",)).select(*SEED).distinct(), "asked")
        if index is not None:
            index = staged(index.join(broadcast_if_small(asked, FEW), list(SEED), "left_semi"), "asked-seeds")
        else:
            keep, _ = _asked_filter(sequences, _bases(tiles) if bases is None else bases, k, 1)
            index = staged(kmer_index(tiles, k, max_occ, tile, asked, keep=keep), "asked-seeds")
    elif span >= k:
        keep, kmers = _asked_filter(sequences, _bases(tiles) if bases is None else bases, k, 1)
        index = _union([staged(kmer_index(tiles, k, max_occ, tile, first=first, keep=keep), "asked-seeds") for first in _rounds(kmers)])
    most = seed_frequencies(index).agg(F.max("occ").alias("n")).first()["n"] or 0 if span >= k else 0
    found, top, low, wide = [], 0, None, None
    left = sequences
    while span >= k and left.take(1):
        high = max_occ * class_factor ** top
        in_class = F.col("occ").isNull() if low is None else (F.col("occ") > low) & (F.col("occ") <= high)
        places = index.where(in_class)
        # Most seeds have no place in a class: they are not moved to look for one.
        held = places.count() if n_seeds > FEW else None
        seeds = read_kmers(left, k, 1, ("sid", "reference"), keep=None if held is None else filter_of_codes(places, held))
        if high <= SALTED:
            wide = staged(_wide(tiles, span, tile), "wide") if wide is None else wide
            placed = _by_place(seeds, places, sequences, wide, tile)
        else:
            placed = _by_text(seeds, places, sequences, tiles, span, k, tile, max(1, high // SALTED))
        by_nm = placed.where(F.col("nm") <= max_mm).groupBy("sid", "nm").agg(
            F.min(F.struct("contig_idx", "start", "strand")).alias("place"), F.sum("copies").alias("n"))
        best = staged(by_nm.groupBy("sid").agg(
            F.min(F.struct("nm", "place", "n")).alias("best"), F.sort_array(F.collect_list("nm")).alias("all_nm")), "placed")
        found.append(best)
        left = left.join(best, "sid", "left_anti")
        top, low = top + 1, max_occ if low is None else high
        if low >= most:
            break
    if not found:
        return reads.select("read_id", "reference", *[F.lit(None).cast(t).alias(c) for c, t in _HIT]).where(F.lit(False))
    every = _union(found)
    gap = F.coalesce(F.get("all_nm", F.lit(1)), F.lit(max_mm + 1)) - F.col("best.nm")
    rows = every.join(sequences, "sid").select("reference", "seq", F.col("best.place.contig_idx").alias("contig_idx"), F.col("best.place.start").alias("start"),
                        F.col("best.place.strand").alias("strand"), F.lit(0).cast("long").alias("votes"), F.lit(0).cast("long").alias("second_votes"),
                        F.when(F.col("best.n") > 1, 0).otherwise(F.floor(60 * gap / (max_mm + 1))).cast("int").alias("mapq"),
                        (F.col("best.n") > 1).alias("repeat"))
    return staged(reads.select("read_id", "reference", "seq").join(rows, ["reference", "seq"]).select(
        "read_id", "reference", *[c for c, _ in _HIT]), "rescued")


_HIT = (("contig_idx", "long"), ("start", "long"), ("strand", "int"), ("votes", "long"), ("second_votes", "long"), ("mapq", "int"),
        ("repeat", "boolean"))


def _mismatches(a, b):
    """Positions at which two strings of one length differ; each is cut into bases once, equal ones not at all."""
    differ = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), lambda differ: differ))
    return F.when(a == b, F.lit(0)).otherwise(differ)


def verify_hits(hits: DataFrame, reads: DataFrame, tiles: DataFrame, max_mm: int = 4,
                tile: int = 65536) -> DataFrame:
    """A3: ungapped check of each hit against the reference.

    Returns one alignment row per read and reference: read_id, reference,
    contig_idx, contig, pos (1-based), strand, flag, cigar, mapq, votes,
    second_votes, repeat (another place is as good), nm, seq (as on the forward
    strand), qual, plus the read's other columns.  Reads with no hit, off-contig hits or more than ``max_mm`` mismatches are unmapped
    (flag 4, no position).

    Hits go to the tiles without their reads (the length is all that is needed there) and come back with the bases
    under the read: neither a tile nor a read's other columns are moved there. They then meet their reads in one
    exchange. A read of any length is checked: one that runs over several tiles meets each of them.  Reads
    without a hit stay out of the tile join.
    """
    return compare_bases(bases_under(hits, reads, tiles, tile, 0 if _repeated(reads) else _overlap(tiles, tile)), reads, max_mm)


def bases_under(hits: DataFrame, reads: DataFrame, tiles: DataFrame, tile: int = 65536, overlap: int = 0) -> DataFrame:
    """A3, first step, written: the hits of ``reads`` with their contig and ``refseq``, the reference under the read
    (null without a hit).  ``_several`` marks hits over several tiles.  Hits may bring the length of their read, ``_len``.

    With ``overlap``, by which every tile reaches into the next, a read that ends in it meets one tile. That is for
    reads whose ids are not repeated: rows over several tiles are made one per id.

    A step of its own, so that the disk does not hold the exchanges of the tiles and of the reads at a time."""
    ref = F.col("reference") if "reference" in tiles.columns else F.lit("ref")
    t = tiles.select(ref.alias("t_reference"), F.col("contig_idx").alias("t_contig"), "contig", F.col("tile").alias("t_tile"),
                     F.col("start").alias("tile_start"), F.col("seq").alias("tile_seq"), "contig_len")
    if "_len" in hits.columns:
        j = hits.where("_len IS NOT NULL AND read_id IS NOT NULL")
    else:
        j = hits.join(reads.select("read_id", F.length("seq").alias("_len")).distinct(), "read_id")
    end = F.col("start") + F.col("_len")
    first, last = F.floor(F.greatest(F.col("start"), F.lit(0)) / tile), F.floor(F.greatest(end - 1, F.lit(0)) / tile)
    last = F.when(end <= (first + 1) * tile + overlap, first).otherwise(last)
    j = j.withColumns({"_first": first.cast("long"), "_last": last.cast("long")})
    # Three branches read these rows: the mapping is run once.
    j = staged(j, "hits")
    has_hit = F.col("contig_idx").isNotNull()

    def under(df: DataFrame) -> DataFrame:
        """``df`` with ``part``, the reference under the read inside the tile ``_tile``."""
        met = df.join(t, (F.col("reference") == F.col("t_reference")) & (F.col("contig_idx") == F.col("t_contig"))
                      & (F.col("_tile") == F.col("t_tile")))
        low = F.greatest(F.col("start"), F.col("tile_start"))
        high = F.least(F.col("start") + F.col("_len"), F.col("tile_start") + tile + F.when(F.col("_first") == F.col("_last"), overlap).otherwise(0))
        return met.withColumn("part", F.substring(F.col("tile_seq"), (low - F.col("tile_start") + 1).cast("int"),
                                                  F.greatest(high - low, F.lit(0)).cast("int"))
                              ).drop("t_reference", "t_contig", "t_tile", "tile_start", "tile_seq")

    inside_one = under(j.where(has_hit & (F.col("_first") == F.col("_last"))).withColumn("_tile", F.col("_first")))
    over_more = under(j.where(has_hit & (F.col("_first") < F.col("_last"))).withColumn(
        "_tile", F.explode(F.sequence("_first", "_last"))))
    row = [c for c in j.columns if c not in ("read_id", "reference")]
    # At most a read's length / tile pieces are gathered, where the read will be joined.
    joined = (over_more.repartition("read_id").groupBy("read_id", "reference").agg(
        F.min(F.struct(*row, "contig", "contig_len")).alias("x"), F.sort_array(F.collect_list(F.struct("_tile", "part"))).alias("_parts"))
        .select("read_id", "reference", "x.*", F.array_join(F.transform("_parts", lambda p: p["part"]), "").alias("refseq")))
    lost = j.where(~has_hit).withColumns({"contig": F.lit(None).cast("string"), "contig_len": F.lit(None).cast("int"), "refseq": F.lit(None).cast("string")})
    inside_one = inside_one.withColumnRenamed("part", "refseq").drop("_tile")
    one, more = inside_one.unionByName(lost).withColumn("_several", F.lit(False)), joined.withColumn("_several", F.lit(True))
    return staged(one.unionByName(more).drop("_first", "_last"), "bases")


def compare_bases(bases: DataFrame, reads: DataFrame, max_mm: int = 4) -> DataFrame:
    """A3, second step: the rows of ``bases_under`` meet their reads, in one exchange, and are compared with them."""
    extra = [c for c in reads.columns if c not in ("read_id", "seq", "qual")]
    r = reads.withColumnRenamed("seq", "read_seq")
    if "qual" not in reads.columns:
        r = r.withColumn("qual", F.lit(None).cast("string"))

    def with_reads(df: DataFrame) -> DataFrame:
        back = F.col("strand") == 1
        return df.join(r, "read_id").where(F.length("read_seq").eqNullSafe(F.col("_len"))).withColumns({
            "aseq": F.when(back, revcomp(F.col("read_seq"))).otherwise(F.col("read_seq")),
            "aqual": F.when(back, F.reverse("qual")).otherwise(F.col("qual"))}).drop("read_seq", "qual", "_len", "_several")

    single = with_reads(bases.where("NOT _several"))
    # Rows of a read over several tiles are one row, also where its id is repeated; they are where their id is.
    several = with_reads(bases.where("_several"))
    several = several.groupBy("read_id", "reference").agg(
        F.min(F.struct(*[c for c in several.columns if c not in ("read_id", "reference")])).alias("x")).select("read_id", "reference", "x.*")
    found = single.unionByName(several)
    fits = (F.col("start") >= 0) & (F.col("start") + F.length("aseq") <= F.col("contig_len")) \
        & (F.length("refseq") == F.length("aseq"))
    found = found.withColumn("nm", F.when(fits, _mismatches(F.col("aseq"), F.col("refseq"))))
    return _alignment(found, F.coalesce(F.col("nm") <= max_mm, F.lit(False)), extra)


def _alignment(j: DataFrame, ok, extra: list[str]) -> DataFrame:
    return j.select(
        "read_id", *extra, "reference",
        F.when(ok, F.col("contig_idx")).alias("contig_idx"), F.when(ok, F.col("contig")).alias("contig"),
        F.when(ok, F.col("start") + 1).cast("long").alias("pos"),
        F.when(ok, F.col("strand")).alias("strand"),
        F.when(ok, F.when(F.col("strand") == 1, F.lit(REVERSE_FLAG)).otherwise(F.lit(0))).otherwise(F.lit(UNMAPPED_FLAG)).alias("flag"),
        F.when(ok, F.concat(F.length("aseq").cast("string"), F.lit("M"))).alias("cigar"),
        F.when(ok, F.col("mapq")).otherwise(F.lit(0)).alias("mapq"),
        *[F.when(ok, F.col(c)).otherwise(F.lit(0)).cast("long").alias(c) for c in ("votes", "second_votes")],
        F.coalesce(ok & F.col("repeat"), F.lit(False)).alias("repeat"),
        F.when(ok, F.col("nm")).alias("nm"),
        F.col("aseq").alias("seq"), F.col("aqual").alias("qual"),
        # the reference under the read (what an MD tag encodes): lets pileup and
        # calling see the reference base without joining back to the tiles
        F.when(ok, F.col("refseq")).alias("ref_seq"))


def align_reads(reads: DataFrame, tiles: DataFrame, k: int = 15, max_occ: int = 64, max_mm: int = 4,
                tile: int = 65536, stride: int | None = None, references: list[str] | None = None,
                class_factor: int = CLASS_FACTOR, index: DataFrame | None = None, with_bases: bool = True,
                dealt: bool = False) -> DataFrame:
    """A1-A3 together.  Reads without any hit still come out (unmapped), once per
    reference (``references`` defaults to the names present in ``tiles``).  ``index`` is
    the k-mer table of ``tiles``, written, where a caller maps several sets of reads.  Without ``with_bases`` the rows
    are written without seq, qual and ref_seq, for callers that only want the places.  Tiles that are ``dealt`` are a
    written table of as many files as tasks."""
    slim = () if with_bases else ("seq", "qual", "ref_seq")
    if references is None:
        if "reference" in tiles.columns:
            references = sorted({r.reference for r in tiles.select("reference").distinct().collect()})
        else:
            references = ["ref"]
    # Not written where it is used once: the votes go on from its exchange, and the further rounds filter it first.
    seqs = reads.select("read_id", "seq")
    bases, rounds, keep = None, (None,), None
    if index is None:
        # Every step reads the tiles: they are made once, in as many files as tasks.
        tiles = tiles if dealt else staged(spread(tiles), "tiles")
        bases = _bases(tiles)
        keep, kmers = _asked_filter(seqs, bases, k, stride or k)
        rounds = _rounds(kmers)
    if len(rounds) == 1:
        hits = vote_hits(seqs, kmer_index(tiles, k, max_occ, tile, keep=keep, dealt=True) if index is None else index, k, stride, references)
    else:
        hits = best_votes(_union([staged(seed_hits(seqs, kmer_index(tiles, k, max_occ, tile, first=first, keep=keep, dealt=True), k, stride, references, first),
                                         "seed-hits") for first in rounds]))
    repeated = _repeated(reads)
    per_ref = reads.select("read_id", *([] if repeated else [F.length("seq").alias("_len")]), F.explode(F.array(*[F.lit(r) for r in references])).alias("reference"))
    under = bases_under(per_ref.join(hits, ["read_id", "reference"], "left"), reads, tiles, tile, 0 if repeated else _overlap(tiles, tile))
    # Reads meet the bases in as many rounds, each with its share of the read ids.
    first = _union([staged(compare_bases(_share(under, i, len(rounds)), _share(reads, i, len(rounds)), max_mm).drop(*slim), "verified")
                    for i in range(len(rounds))])
    lost = first.where(F.col("flag") == UNMAPPED_FLAG).select("read_id", "reference")
    lost_reads = lost.join(reads.select("read_id", "seq"), "read_id")
    rescued = rescue_reads(lost_reads, index, tiles, k, max_occ, max_mm, tile, class_factor, bases)
    # Written, as the steps that follow read the alignments more than once (a range partition samples them first).
    # Where few reads were placed anew, the others are not exchanged again.
    placed = broadcast_if_small(rescued.select("read_id", "reference"), FEW)
    again = staged(verify_hits(rescued, reads.join(placed, "read_id", "left_semi"), tiles, max_mm, tile).drop(*slim), "verified")
    return first.join(placed, ["read_id", "reference"], "left_anti").select(*again.columns).unionByName(again)


def map_reads(reads: DataFrame, tiles: DataFrame, k: int = 15, max_occ: int = 64, max_mm: int = 4, tile: int = 65536,
              stride: int | None = None, references: list[str] | None = None, class_factor: int = CLASS_FACTOR) -> DataFrame:
    """A2: the place of every read per reference, all rounds: read_id, reference, contig_idx, start (0-based), strand,
    votes (0 where no rare seed at a sparse offset placed it), second_votes, mapq, repeat; a read without a place has nulls."""
    return align_reads(reads.select("read_id", "seq"), tiles, k, max_occ, max_mm, tile, stride, references, class_factor, with_bases=False).select(
        "read_id", "reference", "contig_idx", (F.col("pos") - 1).alias("start"), "strand", "votes", "second_votes", "mapq", "repeat")


def sort_alignments(aln: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """A4: coordinate order (reference, contig order, position; unmapped last),
    range-partitioned so each partition is a contiguous, sorted slice."""
    keys = ["reference", F.col("contig_idx").asc_nulls_last(), F.col("pos").asc_nulls_last(), "strand", "read_id"]
    parted = aln.repartitionByRange(num_partitions, *keys) if num_partitions else aln.repartitionByRange(*keys)
    return parted.sortWithinPartitions(*keys)


def merge_runs(aln: DataFrame) -> DataFrame:
    """A5: all run alignments of a sample × reference as one read-grouped set.

    No data moves beyond the coordinate sort: the read group is the run id and
    the set is addressed by (sample_id, reference) partition columns."""
    return aln.withColumn("read_group", F.col("run_id"))


def bucket_samples(aln: DataFrame, sample_buckets: int) -> DataFrame:
    return aln.withColumn("sample_bucket", F.abs(F.xxhash64("sample_id")) % sample_buckets)


def write_merged(aln: DataFrame, path: str, sample_buckets: int = 64, num_partitions: int | None = None) -> None:
    """Write merged, sorted alignments partitioned by reference and a sample
    bucket (not one directory per run or sample: small files).

    Range-partitioned on (reference, bucket, coordinates), so each task writes
    one contiguous, coordinate-sorted slice of one or two bucket directories
    instead of a file into every bucket."""
    out = bucket_samples(merge_runs(aln), sample_buckets)
    keys = ["reference", "sample_bucket", F.col("contig_idx").asc_nulls_last(), F.col("pos").asc_nulls_last(),
            "strand", "read_id"]
    parted = out.repartitionByRange(num_partitions, *keys) if num_partitions else out.repartitionByRange(*keys)
    (parted.sortWithinPartitions(*keys).write.mode("overwrite")
     .partitionBy("reference", "sample_bucket").parquet(path))


def tile_regions(aln: DataFrame, size: int) -> DataFrame:
    """region = floor((pos − 1) / size) for mapped reads."""
    return aln.withColumn("region", F.floor((F.col("pos") - 1) / F.lit(size)).cast("long"))


def merge_regions(tiled: DataFrame) -> DataFrame:
    """A6 final merge: region tiles back to one coordinate-sorted set."""
    return sort_alignments(tiled.drop("region"))


def write_regions(aln: DataFrame, path: str, size: int, folders: tuple[str, ...] = (), num_partitions: int | None = None) -> None:
    """A6 as a layout: rows with their ``region``, ranged and sorted by ``folders`` and coordinates, a folder per value
    of ``folders`` (``reference`` first, if any).

    Every file is a run of neighbouring regions (a large region is several files), so a lookup of a region prunes by
    the files' statistics, and ``merge_region_parts`` puts the files in order without sorting rows again.
    """
    by = [c for c in folders if c != "reference"]
    keys = ["reference", *by, F.col("contig_idx").asc_nulls_last(), F.col("pos").asc_nulls_last(), "strand", "read_id"]
    tiled = tile_regions(aln, size)
    parted = tiled.repartitionByRange(num_partitions, *keys) if num_partitions else tiled.repartitionByRange(*keys)
    parted.sortWithinPartitions(*keys).write.partitionBy(*folders).parquet(path)


def region_parts(spark: SparkSession, path: str, folders: tuple[str, ...] = ()) -> DataFrame:
    """The part table of ``write_regions``: per file ``part`` (its number in coordinate order), ``before`` (rows of the
    parts before it), ``n_rows``, ``first_region`` and ``last_region``. A row per file: its windows are as small."""
    by = [c for c in folders if c != "reference"]
    first = F.struct("reference", *by, F.col("contig_idx").isNull().alias("unmapped"), "contig_idx", "pos", "strand", "read_id")
    files = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(
        F.min(first).alias("first"), F.count(F.lit(1)).alias("n_rows"), F.min("region").alias("first_region"), F.max("region").alias("last_region"))
    order = Window.orderBy("first", "_file")
    before = F.coalesce(F.sum("n_rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.select("_file", F.row_number().over(order).alias("part"), before.alias("before"), "n_rows", "first_region", "last_region")


def merge_region_parts(spark: SparkSession, path: str, folders: tuple[str, ...] = (), num_partitions: int | None = None) -> DataFrame:
    """A6 final merge: the rows of ``write_regions`` as one coordinate-sorted set, with ``row_number`` (1-based).

    The order is that of the part table and of the rows in their files: each row goes to the partition of its part's
    number in one exchange. Coordinates are neither sampled nor compared again.
    """
    by = [c for c in folders if c != "reference"]
    parts = cut_lineage(region_parts(spark, path, folders))
    n_files = max(parts.count(), 1)
    n = min(num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), n_files)
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    placed = rows.join(broadcast_if_small(parts.select("_file", "part", "before")), "_file")
    target = F.floor((F.col("part") - 1) * n / n_files).cast("int")
    return (placed.repartitionById(n, target).sortWithinPartitions("reference", *by, "part", "_row")
            .withColumn("row_number", F.col("before") + F.col("_row") + 1).drop("_file", "_row", "part", "before", "region"))


def index_alignments(aln: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per (reference, contig, window of start position): rows, min/max
    start, max end — enough to prune a region lookup to a few windows."""
    mapped = aln.where(F.col("pos").isNotNull())
    end = F.col("pos") + F.length("seq") - 1
    return (mapped.withColumn("window", F.floor((F.col("pos") - 1) / F.lit(window)).cast("long"))
            .groupBy("reference", "contig_idx", "contig", "window")
            .agg(F.count("*").alias("n_reads"), F.min("pos").alias("min_pos"), F.max("pos").alias("max_pos"),
                 F.max(end).alias("max_end")))


# Columns of the layout by window, beside those of the alignments.
LAYOUT = {"_reference": T.StringType(), "_cell": T.LongType()}


def _laid(window, cells: int) -> dict:
    """Windows of start positions dealt into ``cells``: neighbouring ones next to each other, contigs from anywhere."""
    return {"_reference": F.col("reference"), "_cell": F.pmod(F.xxhash64(F.col("contig_idx").cast("long")) + window, F.lit(cells))}


def write_windows(aln: DataFrame, path: str, window: int = WINDOW, cells: int = 256, rounds: int = 1) -> None:
    """Write alignments laid out by reference and cell of windows (start positions), sorted by coordinates inside:
    a lookup opens the files of its windows' cells alone, however many contigs there are.

    A range partition by coordinates, so a task writes neighbouring windows (few small files) and a window
    that holds many reads is split over tasks. Unmapped reads have a folder of their own.

    With ``rounds`` that many runs of cells are exchanged one after the other, so that the disk holds the exchange of
    one; each round scans ``aln``, which should be a written table.
    """
    keys = [F.col(c).asc_nulls_last() for c in (*LAYOUT, "contig_idx", "pos", "read_id")]
    laid = aln.withColumns(_laid(F.floor((F.col("pos") - 1) / F.lit(window)).cast("long"), cells))
    for i in range(rounds):
        # Cells of a round are neighbours; rows without a position go with the first.
        part = laid if rounds == 1 else laid.where(F.coalesce(F.floor(F.col("_cell") * rounds / cells), F.lit(0)) == i)
        (part.repartitionByRange(*keys).sortWithinPartitions(*keys)
         .write.mode("append" if i else "errorifexists").partitionBy(*LAYOUT).option("compression", "zstd").parquet(path))


def scan_windows(spark: SparkSession, path: str) -> DataFrame:
    """The table of ``write_windows``, with the columns of its layout."""
    found = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(f.name, LAYOUT.get(f.name, f.dataType)) for f in found])
    return spark.read.schema(schema).parquet(path)


def query_region(aln: DataFrame, index: DataFrame, contig: str, start: int, end: int,
                 window: int = WINDOW, cells: int = 256) -> DataFrame:
    """A7 lookup: reads overlapping [start, end] (1-based, inclusive).

    The index tells which start windows can hold overlapping reads. On a table of ``write_windows`` (with the
    same window and cells) these prune the files at run time, by dynamic partition pruning, and the sorted rows
    prune inside them; on other tables all rows are scanned. At most ``cells`` rows a reference are broadcast.
    """
    inside = index.where((F.col("contig") == contig) & (F.col("min_pos") <= end) & (F.col("max_end") >= start))
    held = inside.select(*[c.alias(name) for name, c in _laid(F.col("window"), cells).items()]).distinct()
    columns = [c for c in aln.columns if c not in LAYOUT]
    laid = aln if set(LAYOUT) <= set(aln.columns) else aln.withColumns(
        _laid(F.floor((F.col("pos") - 1) / F.lit(window)).cast("long"), cells))
    hits = laid.join(broadcast_if_small(held), list(LAYOUT), "left_semi")
    return hits.where((F.col("contig") == contig) & (F.col("pos") <= end) & (F.col("pos") + F.length("seq") - 1 >= start)).select(*columns)


def _binned(df: DataFrame, cols: tuple[str, str, str], bin_size: int, prefix: str, wider: list[int] | None) -> DataFrame:
    """A row per interval and bin, all columns prefixed, with ``_at`` (level, side and bin).

    At its own level an interval is on side 0. Above it, intervals of the left table are on side 1, at the
    levels ``wider``; those of the right table (``wider`` null) are on side 0 at every level, and on side 1 at
    their own. So two intervals meet once, at the own level of the longer one, and two that are both short never
    meet in wide bins.
    """
    _, start, end = (F.col(c) for c in cols)
    own = I.own_level(start, end, bin_size)
    if wider is None:
        entries = F.concat(F.transform(F.sequence(own, F.lit(I.LEVELS - 1)), lambda level: I.entry(level, 0)), F.array(I.entry(own, 1)))
    else:
        above = F.filter(F.lit(wider).cast("array<int>"), lambda level: level > own)
        entries = F.concat(F.array(I.entry(own, 0)), F.transform(above, lambda level: I.entry(level, 1)))
    return df.where(start <= end).select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns],
                                         I.places(start, end, entries, bin_size).alias("_at"))


def overlap_join(left: DataFrame, right: DataFrame, bin_size: int = 1000,
                 lcols=("contig", "start", "end"), rcols=("contig", "start", "end")) -> DataFrame:
    """Interval overlap join (1-based inclusive intervals on the same contig), columns as ``l_`` and ``r_``.

    Bins by length (``functions.intervals``): an interval takes at most two bins a level whatever its length,
    the left ones at the levels that occur on the right (an aggregate over the right table, which should be the
    smaller), the right ones at every level from their own. One equi-join on (contig, level, side, bin); each
    pair is kept in the first bin both share alone. Intervals with a null, or that end before they start,
    overlap nothing; repeated rows are joined each.
    """
    (lc, ls, le), (rc, rs, re_) = ([f"{p}{c}" for c in cols] for p, cols in (("l_", lcols), ("r_", rcols)))
    lx = _binned(left, lcols, bin_size, "l_", I.levels_present(right, *rcols[1:], bin_size))
    rx = _binned(right, rcols, bin_size, "r_", None).withColumnRenamed("_at", "_at2")
    j = lx.join(rx, (lx[lc] == rx[rc]) & (lx["_at"] == rx["_at2"]))
    first_shared = I.bin_of(F.greatest(F.col(ls), F.col(rs)), F.col("_at")["level"], bin_size)
    return (j.where((F.col(ls) <= F.col(re_)) & (F.col(rs) <= F.col(le)) & (F.col("_at")["bin"] == first_shared))
            .drop("_at", "_at2"))
