"""The corpus pipeline: five operators over the documents, each on what the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller writes it as Parquet and reads
it again as the next stage's documents. All stages but the last return the columns of ``documents``; other
columns pass through, whatever their names, as the stages work beside them (see ``_beside``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import language_id, packing, quality_mcd, secret_scan, simhash_dedup
from helixframe.llm.common import checked_broadcast, table, written
from helixframe.session import ship_package, staging_dir

WORKED_ON = ("doc_id", "text", "lang", "source")


def _beside(docs: DataFrame) -> DataFrame:
    """The columns that stages work on, and all but the text in one struct, so that no name clashes with theirs."""
    rest = F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("_rest")
    return docs.select(rest, *[docs[c] for c in WORKED_ON])


def _columns(rows: DataFrame, names: list[str], text: Column | None = None) -> DataFrame:
    """The columns of the documents again, with another text if given."""
    value = F.col("text") if text is None else text
    return rows.select(*[value.alias(c) if c == "text" else F.col("_rest")[c].alias(c) for c in names])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter (or null) and texts whose language is ambiguous.

    An untrained model, as for an empty table or one without languages, rejects nothing that has a letter.
    """
    model = language_id.fit(docs.where(language_id.learnable(docs["doc_id"])))
    found = language_id.predict(_beside(docs), model)
    sure = (F.col("lang_pred") != language_id.UNDETERMINED) & ~F.col("ambiguous") if model.languages else F.col("text").rlike(r"\p{L}")
    return _columns(found.where(sure), docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that fail the base rules or are outliers of their language and source."""
    slim = docs.select("text", "lang", "source")
    estimates = quality_mcd.fit_groups(written(quality_mcd.with_statistics(slim).drop("text")))
    judged = quality_mcd.judge(quality_mcd.with_statistics(_beside(docs)), estimates)
    return _columns(judged.where("kept"), docs.columns)


def _row_key(docs: DataFrame) -> Column:
    """128 bits of hash over all columns and their nulls: the same whenever a row is read, ids null or repeated."""
    values = [c for name in docs.columns for c in (F.isnull(docs[name]), docs[name])]
    return F.struct(*[F.xxhash64(F.lit(salt), *values).alias(f"h{salt}") for salt in range(2)])


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays: that with the smallest id, null ids last, then the
    smallest row key (of rows equal in all columns, one).

    Rows are told apart by their key, not their id: texts that share an id, or have none, are judged each.
    """
    keyed = docs.select(*[docs[c] for c in ("doc_id", "text")], F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("_rest"),
                        _row_key(docs).alias("_row_key"))
    found = written(simhash_dedup.near_duplicates(keyed, row_key="_row_key"))
    others = written(found.where("not survives").select(F.col("row_key").alias("_other")))
    kept = keyed.join(checked_broadcast(others, 32), keyed["_row_key"] == others["_other"], "left_anti")
    repeated = found.where("survives").groupBy("row_key").count().where("count > 1").take(1)
    return _columns(kept.dropDuplicates(["_row_key"]) if repeated else kept, docs.columns)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by its kind; other texts stay as they are, no document is dropped."""
    ledger = secret_scan.scan_pending(docs, path="doc_id")
    found = secret_scan.attach(_beside(docs), ledger)
    return _columns(found, docs.columns, secret_scan.redact(F.col("text"), F.col("spans")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    pieces = packing.pack(docs)
    return pieces.select("*", F.crc32("ids").alias("ids_crc32"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_duplicates),
    ("secret scans", scan_secrets),
    ("packing", pack),
]

# The tokenizer, the fitted classifier and the components have no SQL form: tests/llm holds the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder before the next reads it."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        at = staging_dir(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
