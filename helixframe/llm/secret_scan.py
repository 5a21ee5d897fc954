"""Secret scans over an incremental blob ledger, in DataFrame operations only.

Each version of each path is addressed by the SHA-256 of its text. A ledger holds what every pair of blob
and rule version gave; only pairs it lacks are scanned, each blob from one of its versions. Findings then
join back to all versions by blob. A blob that many paths share costs one scan and one slim row per path;
the join on the blob has plain shuffled sides, so adaptive execution splits a hot one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import written

SPAN = "struct<start:int,rank:int,stop:int,kind:string>"
FOUND = f"array<struct<rule_set:string,rule_version:string,spans:array<{SPAN}>>>"


class Kind(NamedTuple):
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has at least ``least`` code points."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1


class RuleSet(NamedTuple):
    name: str
    version: str
    kinds: tuple[Kind, ...]


# ``hex`` and ``access`` ask for their least length in the pattern: their matches are whole runs, so a
# shorter one cannot hide a longer one, and short runs need not be listed first.
BASE = RuleSet("base", "1", (
    Kind("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Kind("access", r"AKIA[A-Z0-9]{16,}"),
    Kind("hex", r"[0-9a-f]{24,}"),
))
FORMS = RuleSet("forms", "1", (
    Kind("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*+(?:-{1,4}[^-]++)*+-----END [A-Z ]*PRIVATE KEY-----"),
    Kind("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Kind("host_token", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Kind("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Kind("service_key", r"AIza[A-Za-z0-9_-]{35}"),
))
RULE_SETS = (BASE, FORMS)


# ---------------------------------------------------------------- spans of one text


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column) -> Column:
    """Running sums of an array, from 0 and one longer than it."""
    return F.aggregate(values, F.array(F.lit(0)), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))


def running_sums(values: Column, block: int = 128) -> Column:
    """Running sums of an int array, as long as it: by blocks first, so that a text with very many matches
    does not copy a growing array once per match."""
    n_blocks = F.ceil(F.size(values) / block).cast("int")
    blocks = F.when(n_blocks > 0, F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: _running(
        F.slice(values, b * block + 1, block)))).otherwise(F.expr("CAST(array() AS array<array<int>>)"))
    return _let(blocks, lambda parts: _let(
        _running(F.transform(parts, lambda part: F.element_at(part, -1))),
        lambda before: F.flatten(F.transform(parts, lambda part, i: F.transform(
            F.slice(part, F.lit(2), F.size(part) - 1), lambda x: x + F.get(before, i))))))


def kind_spans(text: Column, kind: Kind, rank: int) -> Column:
    """Code-point spans of one kind. What lies between the matches (``split``) and the matches themselves
    alternate, so their lengths add up to the positions."""
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)) if kind.group else whole
    between = F.split(text, kind.pattern, -1)
    lengths = F.zip_with(between, F.arrays_zip(whole.alias("w"), value.alias("v")), lambda b, m: F.struct(
        F.length(b).alias("gap"), F.length(m["w"]).alias("n"), F.length(m["v"]).alias("value")))
    matches = F.filter(lengths, lambda m: m["n"].isNotNull())
    spans = _let(matches, lambda ms: F.zip_with(
        ms, running_sums(F.transform(ms, lambda m: m["gap"] + m["n"])),
        lambda m, stop: F.struct((stop - m["n"]).alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"),
                                 F.lit(kind.name).alias("kind"), m["value"].alias("value"))))
    long_enough = F.transform(F.filter(spans, lambda s: s["value"] >= kind.least),
                              lambda s: F.struct(s["start"], s["rank"], s["stop"], s["kind"]))
    return F.when(text.rlike(kind.pattern), long_enough.cast(f"array<{SPAN}>")).otherwise(F.expr(f"CAST(array() AS array<{SPAN}>)"))


def rule_spans(text: Column, rules: RuleSet, first_rank: int) -> Column:
    return F.concat(*[kind_spans(text, kind, first_rank + i) for i, kind in enumerate(rules.kinds)])


def span_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind in listed order, comma-joined."""
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``<kind>``; of overlapping spans the part not yet replaced."""
    start = F.struct(text.alias("rest"), F.lit(0).alias("at"), F.expr("CAST(array() AS array<string>)").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(acc["rest"], F.lit(1), F.greatest(s["start"] - acc["at"], F.lit(0)))
        cut = F.struct(F.substring(acc["rest"], s["stop"] - acc["at"] + 1, F.lit(2**31 - 1)).alias("rest"),
                       s["stop"].alias("at"),
                       F.concat(acc["out"], F.array(before, F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("out"))
        return F.when(s["stop"] <= acc["at"], acc).otherwise(cut)

    return F.when(F.size(spans) > 0, F.aggregate(F.sort_array(spans), start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), acc["rest"]))).otherwise(text)


# ---------------------------------------------------------------- the ledger


def address(text: Column) -> Column:
    """The content address of a text (null: that of the empty text)."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan_pending(versions: DataFrame, path: str = "path", text: str = "text", rule_sets: tuple[RuleSet, ...] = RULE_SETS,
                 ledger: DataFrame | None = None) -> DataFrame:
    """Scan the pairs of blob and rule version that the ledger lacks; returns their ledger rows, written.

    ``versions`` has a row per historical version of a path; ``ledger`` is an earlier result (or several,
    united). Result: ``blob`` and ``found``, an array with an entry per rule set scanned now. A blob
    without a pending pair gives no row. Null texts are empty blobs; a null path is a path; repeated rows
    and copies are scanned once. Other columns are not read. An empty table gives no rows.
    """
    source = versions.select(versions[path].alias("_path"), F.coalesce(versions[text], F.lit("")).alias("_text"),
                             address(versions[text]).alias("blob"))
    chosen = source.groupBy("blob").agg(F.min("_path").alias("_chosen"))
    wanted = F.array(*[F.concat_ws("/", F.lit(r.name), F.lit(r.version)) for r in rule_sets])
    if ledger is None:
        chosen = chosen.withColumn("_pending", wanted)
    else:
        done = (ledger.select("blob", F.explode("found").alias("f"))
                .groupBy("blob").agg(F.collect_set(F.concat_ws("/", "f.rule_set", "f.rule_version")).alias("_done")))
        chosen = (chosen.join(done, "blob", "left")
                  .withColumn("_pending", F.array_except(wanted, F.coalesce("_done", F.expr("CAST(array() AS array<string>)"))))
                  .where(F.size("_pending") > 0).drop("_done"))
    # One row per blob with its text. The chosen rows are slim, so they are the side that is hashed and the
    # texts need no sort.
    unseen = source.join(chosen.withColumnRenamed("blob", "_blob").hint("shuffle_hash"),
                         source["_path"].eqNullSafe(F.col("_chosen")) & (source["blob"] == F.col("_blob")), "inner")
    entries, rank = [], 0
    for rules in rule_sets:
        is_pending = F.array_contains("_pending", f"{rules.name}/{rules.version}")
        entries.append(F.when(is_pending, F.struct(
            F.lit(rules.name).alias("rule_set"), F.lit(rules.version).alias("rule_version"),
            rule_spans(F.col("_text"), rules, rank).alias("spans"))))
        rank += len(rules.kinds)
    scanned = unseen.select("blob", F.filter(F.array(*entries), lambda e: e.isNotNull()).cast(FOUND).alias("found"))
    # Repeated rows of the chosen path were scanned alike: one of them stays.
    return written(scanned.groupBy("blob").agg(F.first("found").alias("found")))


def attach(versions: DataFrame, ledger: DataFrame, text: str = "text", rule_sets: tuple[RuleSet, ...] = RULE_SETS,
           keep: list[str] | None = None) -> DataFrame:
    """Join findings back: every row of ``versions`` with ``spans``, what the given rule versions found in its blob.

    All rows are kept, with the ``keep`` columns (all, if not given); a column named ``spans`` is replaced.
    ``ledger`` has a row per blob; blobs that it lacks count as clean.
    """
    columns = [c for c in (keep or versions.columns) if c != "spans"]
    current = [f"{r.name}/{r.version}" for r in rule_sets]
    hit = ledger.select(F.col("blob").alias("_hit"), F.flatten(F.transform(F.filter(
        "found", lambda f: F.concat_ws("/", f["rule_set"], f["rule_version"]).isin(current)),
        lambda f: f["spans"])).alias("_spans")).where(F.size("_spans") > 0)
    addressed = versions.withColumn("_blob_of", address(versions[text])).select(*columns, "_blob_of")
    joined = addressed.join(hit, addressed["_blob_of"] == hit["_hit"], "left")
    return joined.select(*[addressed[c] for c in columns],
                         F.coalesce(hit["_spans"], F.expr(f"CAST(array() AS array<{SPAN}>)")).alias("spans"))


def merge_ledgers(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per blob with the entries of both."""
    both = old.select("blob", "found").unionByName(new.select("blob", "found"))
    return both.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"))
