"""Manifest operators: normalise (M2), validate (M3), sample filter (M4),
expected files (M5), grouping by sample (M6/M7), reference selection (M9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.functions.paths import dir_of

# Header aliases of the five required fields and the typed optional columns.
DEFAULT_ALIASES = {
    "run_id": ["Run", "runId"],
    "sample_id": ["SRA_Sample", "sampleId"],
    "study_id": ["SRA_Study", "studyId"],
    "layout": ["LibraryLayout"],
    "platform": ["Platform", "platform"],
    "center_name": ["Center_Name"],
}
TYPED_COLUMNS = {
    "avg_spot_len": ("AvgSpotLen", "int"),
    "insert_size": ("InsertSize", "int"),
    "mbases": ("MBases", "bigint"),
    "mbytes": ("MBytes", "bigint"),
}
REQUIRED = ("run_id", "sample_id", "study_id", "layout", "platform")
# Files per run by library layout.
LAYOUT_FILES = {"PAIRED": 2, "SINGLE": 1}


def _blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def normalise_manifest(df: DataFrame, aliases: dict | None = None) -> DataFrame:
    """M2: pick the required fields from ``attrs`` by header alias, type the
    optional numeric columns (``try_cast``) and parse both date forms."""
    aliases = aliases or DEFAULT_ALIASES
    cols = {}
    for name, names in aliases.items():
        cols[name] = _blank_to_null(F.coalesce(*[F.col("attrs")[a] for a in names]))
    for name, (header, typ) in TYPED_COLUMNS.items():
        cols[name] = _blank_to_null(F.col("attrs")[header]).try_cast(typ)
    # ReleaseDate is a date in one form and an ISO timestamp in the other.
    rel = _blank_to_null(F.col("attrs")["ReleaseDate"])
    cols["release_ts"] = F.coalesce(F.try_to_timestamp(rel, F.lit("yyyy-MM-dd'T'HH:mm:ssX")),
                                    F.try_to_timestamp(rel, F.lit("yyyy-MM-dd")))
    cols["load_date"] = F.try_to_timestamp(_blank_to_null(F.col("attrs")["LoadDate"]),
                                           F.lit("yyyy-MM-dd")).cast("date")
    out = df.withColumns(cols)
    return normalise_fields(out)


def normalise_fields(df: DataFrame) -> DataFrame:
    """Trim the required fields and upper-case the layout (blank → null)."""
    cols = {c: _blank_to_null(F.trim(F.col(c))) for c in REQUIRED if c in df.columns}
    if "layout" in cols:
        cols["layout"] = F.upper(cols["layout"])
    return df.withColumns(cols)


def missing_reasons(df: DataFrame) -> Column:
    """Array of reasons a row cannot be processed (empty when it can)."""
    checks = [F.when(F.col(c).isNull() | (F.trim(F.col(c)) == ""), F.lit(f"missing:{c}")) for c in REQUIRED]
    checks.append(F.when(F.col("layout").isNotNull() & ~F.upper(F.trim(F.col("layout"))).isin(*LAYOUT_FILES),
                         F.lit("bad:layout")))
    return F.array_compact(F.array(*checks))


def validate_manifest(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M3: (good, quarantine).  Nothing is dropped: every row lands in exactly one."""
    tagged = df.withColumn("reasons", missing_reasons(df))
    good = tagged.where(F.size("reasons") == 0).drop("reasons")
    bad = tagged.where(F.size("reasons") > 0)
    return good, bad


def filter_samples(df: DataFrame, include=None, skip=None) -> DataFrame:
    """M4: keep samples in ``include`` (empty or None: all) and not in ``skip``; skip wins.

    Both may be a list, a comma-joined string or a DataFrame with ``sample_id``,
    and mean the same in each form.  Lists are a parameter and become an ``IN``
    predicate (pushed to the scan); DataFrames become semi and anti joins, whose
    strategy adaptive execution picks from their measured size.
    """
    for values, keep in ((include, True), (skip, False)):
        if values is None:
            continue
        if isinstance(values, DataFrame):
            names = values.select("sample_id").where(F.col("sample_id").isNotNull()).distinct()
            if keep:
                none_given = names.select(F.count(F.lit(1))).scalar() == 0
                chosen = df.join(names.withColumn("_chosen", F.lit(True)), "sample_id", "left")
                df = chosen.where(F.col("_chosen").isNotNull() | none_given).select(*df.columns)
            else:
                df = df.join(names, "sample_id", "left_anti")
            continue
        names = [v.strip() for v in (values.split(",") if isinstance(values, str) else values) if v and v.strip()]
        if names:
            listed = F.coalesce(F.col("sample_id").isin(names), F.lit(False))
            df = df.where(listed if keep else ~listed)
    return df


def expected_files(df: DataFrame, root: str = "", layout_files: DataFrame | None = None) -> DataFrame:
    """M5: expected FASTQ objects of a run, ``fastq/<study>/<sample>/<run>_<mate>.fastq``.

    Adds ``n_expected``, ``dir`` (directory of the first file, relative to the
    root) and ``files ARRAY<STRUCT<uri, name, path>>`` in mate order.
    ``layout_files`` (layout, n_files) defaults to PAIRED 2 / SINGLE 1.
    """
    base = root.rstrip("/") + "/" if root else ""
    if layout_files is None:
        n_exp = F.coalesce(
            F.when(F.col("layout") == "PAIRED", F.lit(LAYOUT_FILES["PAIRED"]))
             .when(F.col("layout") == "SINGLE", F.lit(LAYOUT_FILES["SINGLE"])), F.lit(0))
        out = df.withColumn("n_expected", n_exp)
    else:
        # A literal layout table: its size is the literal's, broadcast is safe.
        lf = layout_files.select(F.col("layout").alias("_layout"), F.col("n_files").cast("int").alias("_n"))
        out = (df.join(F.broadcast(lf), df["layout"] == lf["_layout"], "left")
               .withColumn("n_expected", F.coalesce(F.col("_n"), F.lit(0))).drop("_layout", "_n"))
    rel_dir = F.concat(F.lit("fastq/"), F.col("study_id"), F.lit("/"), F.col("sample_id"), F.lit("/"))
    files = F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("n_expected"), F.lit(1))),
        lambda i: F.struct(
            F.concat(F.lit(base), rel_dir, F.col("run_id"), F.lit("_"), i.cast("string"), F.lit(".fastq")).alias("uri"),
            F.concat(F.col("run_id"), F.lit("_"), i.cast("string"), F.lit(".fastq")).alias("name"),
            F.concat(rel_dir, F.col("run_id"), F.lit("_"), i.cast("string"), F.lit(".fastq")).alias("path"),
        ))
    files = F.when(F.col("n_expected") > 0, files).otherwise(
        F.array().cast("array<struct<uri:string,name:string,path:string>>"))
    return (out.withColumn("files", files)
            .withColumn("dir", F.when(F.size("files") > 0, dir_of(F.col("files")[0]["path"]))))


def group_by_sample(df: DataFrame, with_files: bool = False) -> DataFrame:
    """M6/M7: one row per sample.

    The grouping keeps per-sample aggregates rather than collecting every run of
    a sample into one array (a sample may hold a large share of all runs); the
    run rows themselves stay keyed by ``sample_id`` via :func:`runs_by_sample`.
    A null run id raises, as a null metadata key does.
    """
    checked = df.withColumn("_chk", F.assert_true(F.col("run_id").isNotNull(), F.lit("null run metadata")))
    aggs = [F.count("*").alias("n_runs"), F.min("run_id").alias("min_run"), F.max("run_id").alias("max_run"),
            F.count_distinct("platform").alias("n_platforms"), F.max("_chk").alias("_chk")]
    if with_files:
        aggs.append(F.sum(F.size("files")).cast("bigint").alias("n_files"))
    return checked.groupBy("sample_id").agg(*aggs).drop("_chk")


def runs_by_sample(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Co-locate the runs of each sample (hash on ``sample_id``) without collecting them."""
    return df.repartition(num_partitions, "sample_id") if num_partitions else df.repartition("sample_id")


REFERENCE_SCHEMA = "array<struct<name:string,fastaUri:string,indexUri:string>>"


def references_from_json(df: DataFrame, json_col: str = "json") -> DataFrame:
    """M9: a JSON array of {name, fastaUri, indexUri} per row → one row per reference."""
    parsed = df.withColumn("_refs", F.from_json(F.col(json_col), REFERENCE_SCHEMA))
    keep = [c for c in df.columns if c != json_col]
    # An unreadable document, or an empty one, is a row without a reference, not a lost one.
    return (parsed.select(*keep, F.explode_outer("_refs").alias("_r"))
            .select(*keep, F.col("_r.name").alias("name"), F.col("_r.fastaUri").alias("fasta_uri"),
                    F.col("_r.indexUri").alias("index_uri")))


def select_references(spark: SparkSession, names: Sequence[str], root: str) -> DataFrame:
    """M9: references by name under a root: ``<root>/<name>/<name>.fa`` (+ ``.fai``)."""
    base = root.rstrip("/")
    rows = [(n, f"{base}/{n}/{n}.fa", f"{base}/{n}/{n}.fa.fai") for n in names]
    return spark.createDataFrame(rows, "name string, fasta_uri string, index_uri string")


def filter_references(refs: DataFrame, names) -> DataFrame:
    """Keep references whose name is in ``names`` (a list or a DataFrame with ``name``)."""
    if isinstance(names, DataFrame):
        return refs.join(names.select("name").distinct(), "name", "left_semi")
    return refs.where(F.col("name").isin(list(names)))
