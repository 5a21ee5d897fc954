"""SimHash near-duplicates by tiled exact comparison.

Every text gets a 64-bit fingerprint. Distinct fingerprints are dealt into tiles by the population counts of
their two halves. Two fingerprints within the radius have counts that differ by no more than it in sum, so
only tiles that close meet. Large tiles are cut into blocks, and a pair of blocks is a unit of work of bounded
size: numpy compares it by exclusive-or and bit counts, again skipping what the counts of the four quarters
rule out. A unit returns the spanning forest of its links, never all pairs, and the forests are joined into
components by alternating star contractions over written tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import written

SEED = 42
HALF = 33            # population counts of 32 bits: 0 to 32


class Settings(NamedTuple):
    shingle: int = 3         # words
    radius: int = 3          # bits
    block: int = 16_384      # fingerprints in a block of a tile, about


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included; no words: zero."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII letters and blanks only
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - shingle + 1
    digest, join = xxhash.xxh64_intdigest, b" ".join
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = np.array([digest(join(words[i:i + shingle]), SEED) for i in range(at, min(n, at + (1 << 16)))], np.uint64)
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > n)
    return int(sum(1 << int(b) for b in bits))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                 row_key: str | None = None) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit integer; ``row_key`` too, if named."""

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = np.array([fingerprint(t, shingle) for t in batch], np.uint64)
            yield pd.Series(found.view(np.int64))

    key = [docs[row_key].alias("row_key")] if row_key else []
    return docs.select(docs[doc_id].alias("doc_id"), *key, of(docs[text]).alias("fp"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---------------------------------------------------------------- links inside one unit of work


def join_labels(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Merge the classes of the linked nodes; a label is the smallest node known in its class."""
    while True:
        a, b = labels[u], labels[v]
        differ = a != b
        if not differ.any():
            return
        u, v, a, b = u[differ], v[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            shorter = labels[labels]
            if (shorter == labels).all():
                break
            labels[:] = shorter


def quarters(fps: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters."""
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def link(left: np.ndarray, right: np.ndarray, radius: int, labels: np.ndarray, offset: int) -> None:
    """Compare every left with every right fingerprint that the quarter counts do not rule out.

    Node numbers are positions in ``left`` and, from ``offset`` on, in ``right``.
    """
    if not len(left) or not len(right):
        return
    left_keys, left_of = np.unique(quarters(left), axis=0, return_inverse=True)
    right_keys, right_of = np.unique(quarters(right), axis=0, return_inverse=True)
    order = np.argsort(right_of.ravel(), kind="stable")
    bounds = np.searchsorted(right_of.ravel()[order], np.arange(len(right_keys) + 1))
    sorted_right = right[order]
    left_order = np.argsort(left_of.ravel(), kind="stable")
    left_bounds = np.searchsorted(left_of.ravel()[left_order], np.arange(len(left_keys) + 1))
    for k, key in enumerate(left_keys):
        near = np.flatnonzero(np.abs(right_keys - key).sum(axis=1) <= radius)
        if not len(near):
            continue
        candidates = np.concatenate([np.arange(bounds[t], bounds[t + 1]) for t in near])
        members = left_order[left_bounds[k]:left_bounds[k + 1]]
        values = sorted_right[candidates]
        for at in range(0, len(members), step := max(1, (1 << 20) // len(values))):
            some = members[at:at + step]
            i, j = np.nonzero(np.bitwise_count(left[some][:, None] ^ values[None, :]) <= radius)
            join_labels(labels, some[i], offset + order[candidates[j]])


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links as a forest: pairs of a fingerprint and the root of its class. ``right`` null: within ``left``."""
    nodes = left if right is None else np.concatenate([left, right])
    labels = np.arange(len(nodes))
    if right is None:
        link(left, left, radius, labels, 0)
    else:
        link(left, right, radius, labels, len(left))
    child = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[child], nodes[labels[child]]


# ---------------------------------------------------------------- units of work


def _near_tiles(tiles: dict[int, int], radius: int) -> list[tuple[int, int, int]]:
    """(tile, partner, blocks of the partner) for every ordered pair of tiles that the counts allow."""
    out = []
    for a in tiles:
        for b, n_blocks in tiles.items():
            if abs(a // HALF - b // HALF) + abs(a % HALF - b % HALF) <= radius:
                out.append((a, b, n_blocks))
    return out


def links(distinct: DataFrame, settings: Settings) -> DataFrame:
    """Links between distinct fingerprints ``fp`` as rows (``v``, ``u``), a forest per unit of work."""
    spark = distinct.sparkSession
    low, high = F.col("fp").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned("fp", 32)
    tiled = distinct.select("fp", (F.bit_count(low) * HALF + F.bit_count(high)).cast("int").alias("tile"))
    sizes = tiled.groupBy("tile").count().collect()  # a row per tile: 33 * 33 at most
    tiles = {r["tile"]: math.ceil(r["count"] / settings.block) for r in sizes}
    pairs = spark.createDataFrame(_near_tiles(tiles, settings.radius) or [(-1, -1, 1)], "tile int, partner int, n_partner int")
    own = spark.createDataFrame(list(tiles.items()) or [(-1, 1)], "tile int, n_own int")
    # Both tables are bounded by the number of tiles (25 near ones for each of 1089 at a radius of 3).
    placed = tiled.join(F.broadcast(own), "tile").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("n_own")).cast("int"))
    met = placed.join(F.broadcast(pairs), "tile").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_partner") - 1)))
    # The unit of two blocks is named by the smaller (tile, block) first; ``side`` tells which one the row is of.
    mine, theirs = F.struct(F.col("tile").alias("t"), F.col("part").alias("b")), F.struct(F.col("partner").alias("t"), F.col("other").alias("b"))
    unit = met.select(F.least(mine, theirs).alias("first"), F.greatest(mine, theirs).alias("second"),
                      (mine > theirs).cast("int").alias("side"), "fp")
    dealt = unit.repartition("first", "second").sortWithinPartitions("first", "second", "side", "fp")
    flat = dealt.select(*[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("first", "second") for c in ("t", "b")], "side", "fp")
    radius = settings.radius

    def solve(key: tuple, sides: list[list[np.ndarray]]) -> pd.DataFrame:
        left, right = (np.concatenate(s).view(np.uint64) if s else np.empty(0, np.uint64) for s in sides)
        v, u = forest(left, None if key[:2] == key[2:] else right, radius)
        return pd.DataFrame({"v": v.view(np.int64), "u": u.view(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come unit by unit; one unit is held at a time."""
        key, sides = None, [[], []]
        for batch in batches:
            table, fps = batch.iloc[:, :5].to_numpy(), batch["fp"].to_numpy()
            cuts = [0, *(np.flatnonzero((table[1:] != table[:-1]).any(axis=1)) + 1).tolist(), len(fps)]
            out = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                found = tuple(table[a][:4].tolist())
                if found != key:
                    if key is not None:
                        out.append(solve(key, sides))
                    key, sides = found, [[], []]
                sides[int(table[a][4])].append(fps[a:b])
            if out:
                yield pd.concat(out)
        if key is not None:
            yield solve(key, sides)

    return flat.mapInPandas(run, "v long, u long")


# ---------------------------------------------------------------- components


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` for every node of the edges (``v``, ``u``), the root being its component's least node.

    Alternating stars: a node's larger neighbours move to its least neighbour, then its smaller ones do, until
    nothing moves; the number of rounds grows with the logarithm of the component's size. Every round is
    written. The join of edges with their node's least neighbour has written sides, so that a node with very
    many neighbours is split by adaptive execution.
    """
    def star(current: DataFrame, both_ways: bool) -> DataFrame:
        near = current.select(F.col("v").alias("a"), F.col("u").alias("b"))
        if both_ways:
            near = near.unionByName(current.select(F.col("u").alias("a"), F.col("v").alias("b")))
        least = written(near.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("c"), F.least("a", "m").alias("m")))
        joined = near.join(least, near["a"] == least["c"])
        if both_ways:
            moved = joined.where("b > a").select(F.col("b").alias("v"), F.col("m").alias("u"))
        else:
            moved = joined.select(F.explode(F.array("a", "b")).alias("v"), F.col("m").alias("u"))
        return written(moved.where("v <> u").distinct())

    def state(current: DataFrame) -> tuple:
        return tuple(current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "u")), F.bit_xor(F.xxhash64("u", "v"))).first())

    current = written(edges.where("v <> u").select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u")).distinct())
    before = state(current)
    for _ in range(most_rounds):
        if not before[0]:
            break
        current = star(star(current, True), False)
        if (after := state(current)) == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = current.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return current.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(roots)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings(),
                    row_key: str | None = None) -> DataFrame:
    """``doc_id``, ``fp`` (signed) and ``component_id``, the least id reachable over links, for every row.

    Words are split at ASCII blanks and lower-cased in A-Z; a text of fewer words than a shingle is one
    shingle; a null or blank text has fingerprint zero and is linked like any other. Copies share a
    fingerprint and are compared once. Repeated rows are kept. Ids may be null: such a row is in the
    component of its fingerprint. Other columns are not read. An empty table gives an empty result.

    With ``row_key``, a column that tells rows apart whatever their ids, come ``row_key`` and ``survives``:
    the row is its component's first by id (nulls last) and key.
    """
    rows = written(fingerprints(docs, doc_id, text, settings.shingle, row_key))
    key = ["row_key"] if row_key else []
    place = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", *key)
    distinct = written(rows.groupBy("fp").agg(F.min(place).alias("least_id")))
    rooted = written(components(links(distinct, settings)))
    linked = written(rooted.join(distinct, rooted["node"] == distinct["fp"]).select("fp", "root", "least_id"))
    least = written(linked.groupBy("root").agg(F.min("least_id").alias("of_root")).withColumnRenamed("root", "_root"))
    moved = linked.join(least, linked["root"] == least["_root"]).select(F.col("fp").alias("_fp"), "of_root")
    classes = written(distinct.join(moved, distinct["fp"] == moved["_fp"], "left").select(
        F.col("fp").alias("class_fp"), F.coalesce("of_root", "least_id").alias("first")))
    survives = [place.eqNullSafe(F.col("first")).alias("survives")] if row_key else []
    return rows.join(classes, rows["fp"] == classes["class_fp"]).select(
        "doc_id", "fp", F.col("first.doc_id").alias("component_id"), *key, *survives)
