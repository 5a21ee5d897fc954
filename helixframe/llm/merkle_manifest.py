"""A Merkle manifest of a dataset: a tree of hashes per language, a tree over their roots, a proof per row.

Rows become slim leaves (a hash of all fields), ranked within their tree by a distributed sort. The digits of
the rank say where a leaf hangs. The digits are grouped away one after the other, from the last, each group
nesting the structs of its children, inside blocks of ``fan_out ** levels`` leaves: one shuffle by block
serves all levels of it. The roots of the blocks are the leaves of the next round, until one is left per tree.
On the way down a block is nested again, the path from the root to the block riding along as one more row of
its group; a transform and an explode per digit then emit every child with its siblings, so proofs need no
join. A task never holds more than a block.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import checked_broadcast, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left:string,right:string>"       # the siblings on both sides, their hashes joined


class Settings(NamedTuple):
    fan_out: int = 8
    levels: int = 4             # of a block: 4096 leaves


# ---------------------------------------------------------------- hashes


def h(value: Column) -> Column:
    """Lowercase hex SHA-256 of a string."""
    return F.sha2(value.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` if null, else the count of UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return h(F.concat(*map(field, values)))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and the siblings on its way."""
    return F.aggregate(steps, leaf, lambda acc, s: h(F.concat(s["left"], acc, s["right"])))


def proof_hash(steps: Column) -> Column:
    return h(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""))


# ---------------------------------------------------------------- ranks


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add ``n``, the rows of the same tree, and ``idx``, the row's place in it from 0, written.

    A distributed sort; rows that are alike in all of ``order`` follow each other in any order, and are told
    apart by where they were read, so that a hot value is spread over several tasks.
    """
    placed = (rows.withColumn("_read", F.monotonically_increasing_id())
              .repartitionByRange(F.col(tree), *order, "_read").sortWithinPartitions(tree, *order, "_read").drop("_read"))
    at = written(placed.withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", 33))
    # A row per partition and tree in it: there are fewer of them than partitions and trees together.
    parts = at.groupBy(F.col("_part").alias("_of_part"), F.col(tree).alias("_tree")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    by_tree = Window.partitionBy("_tree")
    before = written(parts.select("_of_part", "_tree", "_first", F.sum("_n").over(by_tree).alias("n"), (
        F.sum("_n").over(by_tree.orderBy("_of_part")) - F.col("_n")).alias("_before")))
    on = (at["_part"] == before["_of_part"]) & at[tree].eqNullSafe(before["_tree"])
    joined = at.join(checked_broadcast(before, 100), on)
    return joined.select(*rows.columns, "n", (F.col("_at") - F.col("_first") + F.col("_before")).alias("idx"))


# ---------------------------------------------------------------- the tree


def _has_level(level: int, settings: Settings) -> Column:
    """If a tree of ``n`` nodes needs its ``level``-th level (from 1)."""
    return F.col("n") > settings.fan_out ** (level - 1)


def _digits(nodes: DataFrame, settings: Settings) -> DataFrame:
    """``nodes`` with their block and the digits ``d1`` (highest) to the last of their place in it."""
    fan, levels = settings.fan_out, settings.levels
    digits = {f"d{k}": (F.floor(F.col("idx") / fan ** (levels - k)) % fan).cast("int") for k in range(1, levels + 1)}
    return nodes.withColumns({"block": F.floor(F.col("idx") / fan ** levels), **digits})


def _roll_up(nodes: DataFrame, settings: Settings, carried: bool) -> DataFrame:
    """Group the digits away: a row per tree and block with ``n``, its root ``h`` and, if ``carried``, the nested
    ``kids`` and the ``path`` that rode along (its row has no digits, and no child comes of it)."""
    levels = settings.levels
    rows = nodes.repartition("tree", "block")
    for level in range(1, levels + 1):
        kept = ["tree", "block", *[f"d{k}" for k in range(1, levels - level + 1)]]
        digit = f"d{levels - level + 1}"
        child = F.struct(digit, "h", *(["leaf" if level == 1 else "kids"] if carried else []))
        grouped = rows.groupBy(*kept).agg(
            F.max("n").alias("n"), F.sort_array(F.collect_list(F.when(F.col(digit).isNotNull(), child))).alias("kids"),
            *([F.first("path", ignorenulls=True).alias("path")] if carried else []))
        joined = F.array_join(F.transform("kids", lambda k: k["h"]), "")
        rows = grouped.withColumn("h", F.when(_has_level(level, settings), h(joined)).otherwise(F.get("kids", F.lit(0))["h"]))
        rows = rows if carried else rows.drop("kids")
    return rows


def _up(leaves: DataFrame, settings: Settings) -> list[DataFrame]:
    """The nodes of every round, from the leaves to the roots of the trees (``n`` is 1)."""
    rounds, size = [leaves], settings.fan_out ** settings.levels
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        up = _roll_up(_digits(rounds[-1].select("tree", "n", "idx", "h"), settings), settings, False)
        rounds.append(written(up.select("tree", F.ceil(F.col("n") / size).alias("n"), F.col("block").alias("idx"), "h")))
        most = -(-most // size)
    return rounds


def _down(nodes: DataFrame, paths: DataFrame, settings: Settings) -> DataFrame:
    """``leaf`` and ``path`` of every row of ``nodes``, given the ``path`` of every ``tree`` and ``block``."""
    levels = settings.levels
    of_nodes = _digits(nodes.select("tree", "n", "idx", "h", "leaf"), settings)
    rows = _roll_up(of_nodes.unionByName(paths, allowMissingColumns=True), settings, True)
    for k in range(1, levels + 1):
        def with_siblings(kid: Column, i: Column) -> Column:
            def joined(kids: Column) -> Column:
                return F.array_join(F.transform(kids, lambda x: x["h"]), "")
            step = F.struct(joined(F.slice("kids", F.lit(1), i)).alias("left"),
                            joined(F.slice("kids", i + 2, F.lit(settings.fan_out))).alias("right"))
            return F.struct(kid.alias("kid"), step.alias("step"))
        one = rows.select("n", "path", F.explode(F.transform("kids", with_siblings)).alias("at"))
        # From the top: a step further down stands before those above it.
        steps = F.when(_has_level(levels - k + 1, settings), F.concat(F.array("at.step"), "path.steps")).otherwise(F.col("path.steps"))
        path = F.struct(steps.alias("steps"), F.col("path.roots").alias("roots")).alias("path")
        rows = one.select("n", path, F.col("at.kid.kids").alias("kids")) if k < levels else one.select("at.kid.leaf", path)
    return rows


def proofs(rounds: list[DataFrame], paths: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``leaf`` and ``path`` of every leaf, from the nodes of all rounds and the ``path`` of every tree's root."""
    paths = paths.select("tree", F.lit(0).cast("long").alias("block"), "path")
    for nodes in reversed(rounds[1:-1]):
        down = _down(nodes.withColumn("leaf", F.struct("tree", "idx")), paths, settings)
        paths = written(down.select("leaf.tree", F.col("leaf.idx").alias("block"), "path"))
    return _down(rounds[0], paths, settings)


# ---------------------------------------------------------------- the manifest


def manifest(docs: DataFrame, tree: str = "lang", order: str = "doc_id", fields: tuple[str, ...] = FIELDS,
             carry: dict[str, Column] | None = None, settings: Settings = Settings()) -> DataFrame:
    """A row per row of ``docs``: the ``order`` column, ``leaf``, ``subroot``, ``root``, ``steps`` (of ``left`` and
    ``right``, the joined hashes of the siblings on both sides, from the leaf to the root) and the ``carry`` columns.

    The leaf hashes all ``fields``, null or not. Leaves of a tree ascend by ``order`` (nulls first), then by their
    hash; repeated rows are leaves each. A null ``tree`` is a tree like others and the first one. Every
    ``fan_out`` nodes of a level become one, and a lone leaf is its own subroot; the subroots, ordered by the
    bytes of the tree's name, make the root in the same way. Texts are read once and never shuffled. Columns
    beyond the named ones are not read. An empty table gives no rows.
    """
    extra = carry or {}
    slim = docs.select(docs[tree].cast("string").alias("tree"), docs[order].alias("_order"), leaf_hash(*[docs[f] for f in fields]).alias("h"),
                       F.struct(docs[order].alias(order), *[c.alias(name) for name, c in extra.items()]).alias("leaf"))
    leaves = ranked(slim, "tree", ["_order", "h"]).drop("_order")
    leaves = leaves.withColumn("leaf", F.struct("leaf", "h"))
    rounds = _up(leaves, settings)
    of_trees = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "h")
    tops = _up(ranked(of_trees, "tree", ["name"]).withColumn("leaf", F.struct("name", "h")), settings)
    root = tops[-1].select("tree", F.struct(F.expr(f"CAST(array() AS array<{STEP}>)").alias("steps"), F.array("h").alias("roots")).alias("path"))
    of_roots = proofs(tops, root, settings).select(
        F.col("leaf.name").alias("tree"), F.struct("path.steps", F.concat("path.roots", F.array("leaf.h")).alias("roots")).alias("path"))
    found = proofs(rounds, written(of_roots), settings)
    return found.select(f"leaf.leaf.{order}", F.col("leaf.h").alias("leaf"), F.col("path.roots")[1].alias("subroot"),
                        F.col("path.roots")[0].alias("root"), F.col("path.steps").alias("steps"), *[f"leaf.leaf.{name}" for name in extra])


def tampered(text: Column, doc_id: Column) -> Column:
    """The text with A-Z in lower case where 3 divides the CRC-32 of the id, else the text."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0
    return F.when(F.coalesce(hit, F.lit(False)), F.translate(text, UPPER, LOWER)).otherwise(text)


def verified(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The manifest of ``documents`` rows, each checked against the root after some texts were tampered with.

    Adds ``folded_root``, what the leaf as found now and the original siblings fold to, and ``verified``. A row
    with a null id is not tampered with.
    """
    now = [tampered(docs["text"], docs["doc_id"]) if f == "text" else docs[f] for f in FIELDS]
    found = manifest(docs, carry={"leaf_now": leaf_hash(*now)}, settings=settings)
    return found.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("steps")).alias("proof_sha256"),
                        fold(F.col("leaf_now"), F.col("steps")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
