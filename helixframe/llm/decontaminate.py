"""Benchmark decontamination with a broadcast hash set, in DataFrame operations only.

The word windows of the benchmark items are hashed. Every word position of every text looks up the hash of
the window that begins there; a hit is verified by comparing the words. Positions meet the set inside the
task that reads the text, so only hits leave it, and these as bits: 64 word positions of a text to a number,
merged inside the tasks first. A passage that fills a third of all texts therefore costs a few bytes per line.

What was found is kept per distinct text (by 128 bits of hash), so copies share it, and joins back to the rows.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import BROADCAST_BYTES, checked_broadcast, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words are runs of ASCII letters and digits and of all characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Settings(NamedTuple):
    window: int = 10                  # words; a shorter item is one window
    set_bytes: int = 64 << 20         # of the set that is broadcast; a larger benchmark is looked up in parts
    window_bytes: int = 60            # of a window beside its text


def normalised(text: Column) -> Column:
    """A-Z in lower case, other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def text_key(text: Column) -> Column:
    """128 bits of hash of a text (null: that of the empty one)."""
    value = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit("text"), value).alias("b"))


def _words(text: Column) -> Column:
    # The filter makes this a projection outside of generated code: it is evaluated once a text, not once a word.
    return F.filter(F.split(normalised(F.coalesce(text, F.lit(""))), BETWEEN, -1), lambda w: w != "")


def _window_hash(length: int) -> Column:
    return F.xxhash64(*[F.get("words", F.col("pos") + k) for k in range(length)])


def _window_text(length: Column) -> Column:
    return F.array_join(F.slice("words", F.col("pos") + 1, length), " ")


# ---------------------------------------------------------------- the benchmark


def _positions(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Rows with ``words`` to a row per window of one of the lengths: ``pos``, ``length`` and ``h``."""
    last = F.size("words") - min(lengths)
    at = rows.select("*", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("pos"))
    if len(lengths) > 1:
        at = at.select("*", F.explode(F.array(*map(F.lit, lengths))).alias("length")).where(F.col("pos") + F.col("length") <= F.size("words"))
    else:
        at = at.withColumn("length", F.lit(lengths[0]))
    h = reduce(lambda rest, k: rest.when(F.col("length") == k, _window_hash(k)), lengths[1:],
               F.when(F.col("length") == lengths[0], _window_hash(lengths[0])))
    return at.withColumn("h", h)


def windows(items: DataFrame, item_id: str = "item_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """A row per item and distinct window of it: ``item_id``, ``length``, ``h`` and ``window`` (its words), written.

    An item of fewer words than a window is one window; null texts and texts without words have none.
    """
    rows = items.select(items[item_id].alias("item_id"), _words(items[text]).alias("words"))
    long = rows.where(F.size("words") >= settings.window)
    found = _positions(long, [settings.window]).select("item_id", "length", "h", _window_text(F.col("length")).alias("window"))
    for k in range(1, settings.window):
        short = rows.where(F.size("words") == k).withColumn("pos", F.lit(0))
        found = found.unionByName(short.select("item_id", F.lit(k).alias("length"), _window_hash(k).alias("h"),
                                               F.array_join("words", " ").alias("window")))
    return written(found.distinct())


# ---------------------------------------------------------------- texts


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """What the windows of ``benchmark`` (see ``windows``) hit, per distinct text that they hit, written.

    Columns: ``key`` (see ``text_key``), ``n_hit`` (words inside an occurring window), ``hit`` (an array of
    ``block`` and ``mask``: bit i of block b stands for word 64 b + i), ``n_items`` and ``items`` (ids of the
    items with occurring windows, as sorted strings; items without an id hit words, but are not listed).
    """
    distinct = written(benchmark.select("length", "h", "window").distinct().withColumn("window_id", F.monotonically_increasing_id()))
    known = distinct.agg(F.sum(F.octet_length("window") + settings.window_bytes).alias("n"),
                         F.collect_set("length").alias("lengths")).first()  # lengths: at most settings.window numbers
    lengths = sorted(known["lengths"])
    n_parts = 1 + int(known["n"] or 0) // settings.set_bytes
    rows = docs.select(text_key(docs[text]).alias("key"), _words(docs[text]).alias("words"))
    if not lengths:
        rows, lengths = rows.where(F.lit(False)), [settings.window]
    at = _positions(rows, lengths)
    looked_up = distinct.select(F.col("h").alias("_h"), "window", "window_id")
    hits = []
    for part in range(n_parts):
        of_part = looked_up.where(F.pmod(F.xxhash64("_h"), F.lit(n_parts)) == part)
        # Each begins with the other: equal, but no key of the join, so it is evaluated for equal hashes only.
        mine = _window_text(F.col("length"))
        same = (at["h"] == of_part["_h"]) & F.startswith(mine, of_part["window"]) & F.startswith(of_part["window"], mine)
        hits.append(at.join(F.broadcast(of_part), same).select("key", "pos", "length", "window_id"))
    every = reduce(DataFrame.unionByName, hits)

    # A hit is a bit for every word under it (a window may reach over several blocks), and its window.
    first, stop = F.col("pos"), F.col("pos") + F.col("length")
    bits = F.transform(F.sequence(F.floor(first / 64), F.floor((stop - 1) / 64)), lambda b: F.struct(
        b.cast("long").alias("at"), F.lit(False).alias("is_window"), _ones(F.greatest(first - b * 64, F.lit(0)), F.least(stop - b * 64, F.lit(64))).alias("mask")))
    window = F.array(F.struct(F.col("window_id").alias("at"), F.lit(True).alias("is_window"), F.lit(0).cast("long").alias("mask")))
    merged = written(every.select("key", F.explode(F.concat(bits, window)).alias("x")).groupBy(
        "key", "x.is_window", "x.at").agg(F.bit_or("x.mask").alias("mask")))
    words = merged.where("not is_window").groupBy("key").agg(
        F.sum(F.bit_count("mask")).cast("long").alias("n_hit"),
        F.sort_array(F.collect_list(F.struct(F.col("at").alias("block"), "mask"))).alias("hit"))

    # Windows to items: one row per window and item, then one per text and item.
    of_window = written(benchmark.where("item_id IS NOT NULL").join(distinct, ["length", "h", "window"]).select(
        F.col("window_id").alias("_window_id"), F.col("item_id").cast("string").alias("item_id")))
    found = merged.where("is_window").select(F.col("key").alias("_key"), "at")
    pairs = found.join(checked_broadcast(of_window, 40), F.col("at") == F.col("_window_id")).select("_key", "item_id").distinct()
    items = pairs.groupBy("_key").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    both = words.join(items, words["key"] == items["_key"], "left")
    none = F.expr("CAST(array() AS array<string>)")
    return written(both.select("key", "n_hit", "hit", F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                               F.coalesce("items", none).alias("items")))


def _ones(start: Column, stop: Column) -> Column:
    """A long with the bits from ``start`` up to ``stop`` (0 to 64) set."""
    def below(k: Column) -> Column:
        return F.when(k >= 64, F.lit(-1).cast("long")).otherwise(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), k.cast("int"))))
    return below(stop).bitwiseXOR(below(start))


def attach(docs: DataFrame, found: DataFrame, columns: list[Column], text: str = "text") -> DataFrame:
    """``columns`` and what was found in the text, as one column ``found`` (null: nothing), for every row of ``docs``."""
    keyed = docs.select(*columns, text_key(docs[text]).alias("_text_key"))
    names = [c for c in keyed.columns if c != "_text_key"]
    slim = found.select(F.col("key").alias("_found_key"), F.struct("n_hit", "hit", "n_items", "items").alias("found"))
    size = found.agg(F.sum(100 + 20 * F.size("hit") + F.octet_length(F.array_join("items", "  ")))).first()[0] or 0
    joined = keyed.join(F.broadcast(slim) if size <= BROADCAST_BYTES else slim, F.col("_text_key") == F.col("_found_key"), "left")
    return joined.select(*[keyed[c] for c in names], "found")


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items`` and ``contaminated``.

    Null texts have no words. Repeated rows and copies get a row each; null ids stay. Columns beyond the named
    ones are not read. An empty benchmark hits nothing; an empty table gives no rows.
    """
    found = find(docs, windows(benchmark, item_id, item_text, settings), text, settings)
    n_words = F.regexp_count(F.coalesce(docs[text], F.lit("")), F.lit(WORD)).cast("long")
    rows = attach(docs, found, [docs[doc_id].alias("doc_id"), n_words.alias("n_words")], text)
    n_hit, zero = F.col("found.n_hit"), F.lit(0).cast("long")
    return rows.select("doc_id", "n_words", F.coalesce(n_hit, zero).alias("n_hit"), F.coalesce("found.n_items", zero).alias("n_items"),
                       F.coalesce("found.items", F.expr("CAST(array() AS array<string>)")).alias("items"),
                       (F.coalesce(n_hit, zero) > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, what: str = "spans", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` without their hit words (``what="spans"``) or without the documents that have any (``"documents"``).

    All columns and all other rows stay as they are, whatever their names. Of a span of hit words, the
    characters between two of them go as well, and one blank takes the place of the span; the rest of the
    text stays.
    """
    if what not in ("spans", "documents"):
        raise ValueError(f"spans or documents, not {what!r}")
    found = find(docs, windows(benchmark, item_id, item_text, settings), text, settings)
    rows = attach(docs, found, [F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs[text].alias("_text_of")], text)
    if what == "documents":
        return rows.where("found IS NULL").select("_row.*")
    clean = F.when(F.col("found").isNull(), F.col("_text_of")).otherwise(_without(F.col("_text_of"), F.col("found.hit")))
    return rows.select(*[clean.alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns])


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, hit: Column) -> Column:
    """The words that are not hit, with what lies around them."""
    parts = F.struct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"), F.split(text, WORD, -1).alias("around"))

    def flags(words: Column) -> Column:
        """For every word if it is hit, over all blocks: those without a hit, too."""
        every = F.transform(F.sequence(F.lit(0), F.floor((F.size(words) - 1) / 64)), lambda b: F.struct(
            b.cast("long").alias("block"), F.lit(0).alias("found"), F.lit(0).cast("long").alias("mask")))
        of_hits = F.transform(hit, lambda x: F.struct(x["block"].alias("block"), F.lit(1).alias("found"), x["mask"].alias("mask")))
        masks = _let(F.sort_array(F.concat(every, of_hits)), lambda all_: F.filter(
            all_, lambda x, i: F.coalesce(F.get(all_, i + 1)["block"] != x["block"], F.lit(True))))
        return _let(masks, lambda m: F.transform(words, lambda w, i: F.bit_get(
            F.get(m, F.floor(i / 64).cast("int"))["mask"], (i % 64).cast("int")) == 1))

    def joined(x: Column, is_hit: Column) -> Column:
        def piece(w: Column, i: Column) -> Column:
            begins = F.when((i > 0) & F.get(is_hit, i - 1), "").otherwise(" ")
            goes_on = F.get(is_hit, i) & F.coalesce(F.get(is_hit, i + 1), F.lit(False))
            return F.concat(F.when(F.get(is_hit, i), begins).otherwise(w),
                            F.when(goes_on, "").otherwise(F.get(x["around"], i + 1)))
        return F.concat(F.get(x["around"], F.lit(0)), F.array_join(F.transform(x["words"], piece), ""))
    return _let(parts, lambda x: _let(flags(x["words"]), lambda is_hit: joined(x, is_hit)))
