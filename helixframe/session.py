"""Session construction and the shared staging folder."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job wants: adaptive execution re-plans joins from runtime sizes
# (this is where a side is broadcast only after its real size is known), splits
# skewed join partitions and coalesces small shuffle partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    # Skewed join partitions (a hot sample, directory or k-mer) are split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stages here are CPU-bound after large fan-outs (k-mers, bases): merging
    # shuffle partitions by byte size before the fan-out starves cores, so the
    # partition count stays what spark.sql.shuffle.partitions says (size it to
    # the data on a cluster).
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # A folder per sample: listing them takes this many tasks at most, not one a folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # No broadcast on a static estimate: after explode and Python sources those
    # are guesses.  Adaptive execution still broadcasts a side whose *measured*
    # size is small, and explicit broadcasts are for data with a known bound.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # A query is several written steps: the shuffle files of one are removed when it is written, not when the driver
    # collects its garbage, so the disk holds those of one step. (A later reader of a lost one runs its stage again.)
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


# The settings a session built elsewhere must carry for these plans to be safe:
# no broadcast of a guessed size, adaptive skew splitting on, no shuffle files of
# finished steps.  Partition sizing (shuffle partitions, coalescing) stays the
# session owner's choice.
_REQUIRED = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
             "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
             "spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")


def apply_sql_defaults(spark: SparkSession) -> None:
    """Apply the plan-safety settings to an existing session (one built
    elsewhere, e.g. by a scheduler)."""
    for k in _REQUIRED:
        spark.conf.set(k, _DEFAULTS[k])


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "helixframe", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    they can import it wherever the job was started from."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = pathlib.Path(__file__).resolve().parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="helixframe-")).resolve() / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/helixframe-checkpoints") -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a
    local master gets a fallback; a cluster without one is an error, as its
    executors would not see each other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    configured = spark.conf.get("spark.checkpoint.dir", None) or current
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = fallback
        spark.conf.set("spark.checkpoint.dir", configured)
    if not current:
        sc.setCheckpointDir(configured)
    return configured


def staging_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared checkpoint folder for intermediate tables.

    Never a machine-local temp folder: executors on other hosts must see it.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/helixframe-staging/{purpose}-{uuid.uuid4().hex}"


def staged(df, purpose: str):
    """``df`` written once as a table in the shared folder and read from there, which takes a fraction of a checkpoint's
    disk (bases and qualities a half of it again)."""
    at = staging_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def cut_lineage(df, eager: bool = True):
    """``df`` as a table in the shared folder, which survives executor loss. (A checkpoint would make it twice, and the
    second time from the start, as the shuffle files of the first are gone.)"""
    if eager:
        return staged(df, "lineage")
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=False)
