"""Run reconciliation: manifest runs against the objects that really exist.

Rules (one status per input run, precedence top to bottom):

1. run metadata missing (null run id)            → dropped, ``null_key``
2. platform not in ``known_platforms`` (exact)    → anomaly ``Unknown INSTRUMENT: <platform>``
3. no expected files                              → dropped, ``no_files`` (no output at all)
4. objects whose name starts with ``dir + run_id`` ("found") ≠ expected count
     * mate-2 repair enabled, 1 found, 2 expected → repair (see :func:`repair_mate2`)
     * otherwise                                  → anomaly ``Wrong files number for runId (0/<expected>)``
5. equal counts: the found objects replace the expected ones, ordered by the
   integer after the last ``_`` (cut at the first ``.``), ties in name order;
   a name without such a number                   → dropped, ``bad_suffix``
                                                  → otherwise valid

The prefix test is not limited to whole tokens (run ``SRR12`` also takes
``SRR123_1``) and reaches into sub-directories; ``mode='exact'`` matches the run
token of files directly in the directory instead.

Scale: matching is an equi-join on (directory, run id).  Each object is expanded
over the (directory depth, run-id length) pairs present in the manifest (a
scalar array sub-query), so no directory is ever joined against itself pairwise
and no ancestor that is no run's directory gathers all objects under one key.  Counts are partial
aggregates; file lists are only gathered for keys whose count equals the
expected count, so every gathered list is bounded by the layout's file count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.paths import ancestor_at, depth_of, file_name, java_int, mate_suffix

FILE_STRUCT = "array<struct<uri:string,name:string>>"

# Comments written into the anomaly report.
UNKNOWN_INSTRUMENT = "Unknown INSTRUMENT: "
WRONG_FILES_NUMBER = "Wrong files number for runId"
ALREADY_TRIED = "Already tried with _1 paired index"
FILE_NOT_FOUND = "File not found"


def uri_of(root: str, path: Column) -> Column:
    base = root.rstrip("/") + "/" if root else ""
    return F.concat(F.lit(base), path)


def parse_objects(objects: DataFrame) -> DataFrame:
    """R2: directory, file name and mate suffix (null when it does not parse)."""
    return (objects
            .withColumn("dir", F.regexp_extract("path", r"^(.*/)", 1))
            .withColumn("name", file_name("path"))
            .withColumn("suffix", mate_suffix(F.col("name"))))


def _key_shapes(keys: DataFrame) -> Column:
    """The distinct (depth of the directory, length of the run id) present, as a scalar sub-query: one sorted
    array, at most as long as the deepest directory times the longest run id."""
    return keys.select(F.sort_array(F.collect_set(F.struct(depth_of("dir").alias("depth"), F.length("run_id").alias("len"))))).scalar()


def match_run_files(keys: DataFrame, objects: DataFrame, mode: str = "prefix") -> DataFrame:
    """(dir, run_id) keys × objects → one row per (key, matched object).

    ``keys`` needs ``dir`` and ``run_id``; ``objects`` needs ``path`` (relative
    to the listing root).  Output: dir, run_id, path, name, suffix.
    """
    keys = keys.select("dir", "run_id").where(F.col("dir").isNotNull() & F.col("run_id").isNotNull()).distinct()
    obj = parse_objects(objects.select("path"))
    if mode == "exact":
        token = F.regexp_extract(F.col("name"), r"^([^_.]*)", 1)
        cand = obj.select(F.col("dir").alias("_d"), token.alias("_p"), "path", "name", "suffix")
    elif mode == "prefix":
        # only ancestors as deep as some run's directory, with the lengths run ids have there: the root and other
        # shared ancestors would give every object the same few keys, and so one task all objects
        exp = obj.select("path", "name", "suffix", F.explode(_key_shapes(keys)).alias("_shape"))
        exp = exp.where(depth_of("path") >= F.col("_shape.depth")).withColumn("_d", ancestor_at("path", F.col("_shape.depth")))
        exp = exp.where(F.col("_shape.len") <= F.length("path") - F.length("_d"))
        cand = exp.select("_d", F.expr("substring(path, length(_d) + 1, _shape.len)").alias("_p"), "path", "name", "suffix")
    else:
        raise ValueError(f"unknown match mode {mode!r}")
    return (cand.join(keys, (cand["_d"] == keys["dir"]) & (cand["_p"] == keys["run_id"]))
            .select("dir", "run_id", "path", "name", "suffix"))


def object_exists(expected: DataFrame, objects: DataFrame, path_col: str = "path") -> DataFrame:
    """Flag each expected file whether an object with its path exists."""
    present = objects.select(F.col("path").alias("_p")).distinct().withColumn("_e", F.lit(True))
    return (expected.join(present, expected[path_col] == present["_p"], "left")
            .withColumn("exists", F.coalesce(F.col("_e"), F.lit(False))).drop("_p", "_e"))


def platform_gate(df: DataFrame, known_platforms: Sequence[str]) -> Column:
    """Exact, case-sensitive membership (null platform is unknown)."""
    return F.coalesce(F.col("platform").isin(list(known_platforms)), F.lit(False))


def count_check(matched: DataFrame) -> DataFrame:
    """Objects found per (dir, run_id) key and how many lack a numeric mate
    suffix (partial aggregation: a hot key is pre-aggregated per map task)."""
    return matched.groupBy("dir", "run_id").agg(
        F.count("*").alias("_found"), F.count_if(F.col("suffix").isNull()).alias("_bad"))


def order_mates(matched: DataFrame, keys: DataFrame) -> DataFrame:
    """The found objects of ``keys`` ordered by integer mate suffix, ties in
    name order.  Only called for keys whose found count equals the expected
    count, so each gathered list is bounded by the layout's file count."""
    return (matched.join(keys.select("dir", "run_id").distinct(), ["dir", "run_id"], "left_semi")
            .groupBy("dir", "run_id")
            .agg(F.sort_array(F.collect_list(F.struct("suffix", "path", "name"))).alias("_sorted")))


def classify_runs(manifest: DataFrame, objects: DataFrame, known_platforms: Sequence[str],
                  mode: str = "prefix", repair: bool = False, root: str = "") -> DataFrame:
    """One status row per manifest row.

    ``manifest`` needs manifest_row, run_id, platform, dir, files (from
    :func:`expected_files`); ``objects`` needs path (relative to ``root``).
    Adds status, reason, comment, n_expected, n_found, found_files.
    """
    m = manifest.withColumn("n_expected", F.size("files")).withColumn("_gate", platform_gate(manifest, known_platforms))
    active = F.col("run_id").isNotNull() & F.col("_gate") & (F.col("n_expected") > 0)
    keys = m.where(active).select("dir", "run_id")
    matched = match_run_files(keys, objects, mode)

    counts = count_check(matched)
    st = m.join(counts, ["dir", "run_id"], "left").withColumn(
        "n_found", F.when(active, F.coalesce("_found", F.lit(0))).cast("int"))

    ok_keys = st.where(active & (F.col("n_found") == F.col("n_expected"))).select("dir", "run_id")
    ordered = order_mates(matched, ok_keys)
    st = st.join(ordered, ["dir", "run_id"], "left")
    found_files = F.transform("_sorted", lambda x: F.struct(uri_of(root, x["path"]).alias("uri"), x["name"].alias("name")))

    wrong = F.concat(F.lit(WRONG_FILES_NUMBER + " (0/"), F.col("n_expected").cast("string"), F.lit(")"))
    if repair:
        rep = repair_mate2(st.where(active & (F.col("n_found") == 1) & (F.col("n_expected") == 2)), objects, root, keys)
        st = st.join(rep, "manifest_row", "left")
        in_repair = active & (F.col("n_found") == 1) & (F.col("n_expected") == 2)
    else:
        in_repair = F.lit(False)

    status = (F.when(F.col("run_id").isNull(), "dropped")
              .when(~F.col("_gate"), "anomaly")
              .when(F.col("n_expected") == 0, "dropped"))
    reason = (F.when(F.col("run_id").isNull(), "null_key")
              .when(~F.col("_gate"), "unknown_platform")
              .when(F.col("n_expected") == 0, "no_files"))
    comment = F.when(F.col("run_id").isNull(), F.lit(None).cast("string")).when(
        ~F.col("_gate"), F.concat(F.lit(UNKNOWN_INSTRUMENT), F.coalesce(F.col("platform"), F.lit("null")))).when(
        F.col("n_expected") == 0, F.lit(None).cast("string"))
    files = (F.when(F.col("run_id").isNull(), F.lit(None).cast(FILE_STRUCT))
             .when(~F.col("_gate"), F.array().cast(FILE_STRUCT))
             .when(F.col("n_expected") == 0, F.lit(None).cast(FILE_STRUCT)))
    if repair:
        status = (status.when(in_repair & F.col("_rep_vanish"), "dropped")
                  .when(in_repair & (F.size("_rep_files") == 2), "valid")
                  .when(in_repair, "anomaly"))
        reason = (reason.when(in_repair & F.col("_rep_vanish"), "bad_repair_number")
                  .when(in_repair & (F.size("_rep_files") == 2), "repaired")
                  .when(in_repair, "repair_failed"))
        comment = (comment.when(in_repair & (F.col("_rep_vanish") | (F.size("_rep_files") == 2)), F.lit(None).cast("string"))
                   .when(in_repair, F.concat(F.coalesce(F.col("_rep_comment"), F.lit("null")), F.lit(" ("),
                                             F.size("_rep_files").cast("string"), F.lit("/2)"))))
        files = (files.when(in_repair & F.col("_rep_vanish"), F.lit(None).cast(FILE_STRUCT))
                 .when(in_repair & (F.size("_rep_files") == 2), F.col("_rep_files"))
                 .when(in_repair, F.array().cast(FILE_STRUCT)))
    neq = F.col("n_found") != F.col("n_expected")
    bad = F.coalesce(F.col("_bad"), F.lit(0)) > 0
    status = status.when(neq, "anomaly").when(bad, "dropped").otherwise("valid")
    reason = reason.when(neq, "wrong_count").when(bad, "bad_suffix").otherwise("ok")
    comment = comment.when(neq, wrong).otherwise(F.lit(None).cast("string"))
    files = files.when(neq, F.array().cast(FILE_STRUCT)).when(bad, F.lit(None).cast(FILE_STRUCT)).otherwise(found_files)

    out = st.withColumns({"status": status, "reason": reason, "comment": comment, "found_files": files})
    drop = [c for c in out.columns if c.startswith("_")]
    return out.drop(*drop)


def repair_mate2(cands: DataFrame, objects: DataFrame, root: str = "", keys: DataFrame | None = None) -> DataFrame:
    """Mate-2 repair for runs with 1 object found and 2 expected.

    Per expected file, in expected order: an existing object is kept.  A missing
    one is searched only if its mate index (second ``_`` token of the name before
    the first ``.``) is 2, else the comment is ``Already tried with _1 paired
    index``.  The search looks at every object under the run's directory: with
    exactly two there, the first whose full path contains ``_2``; otherwise the
    first whose full path contains ``_2`` and not ``_1`` and whose run number
    (digits after the first three characters of the name up to ``_``) differs by
    one from the run's.  Nothing → ``File not found``.  A number that does not
    parse before the first match makes the run vanish (status dropped).
    "First" is name order, the order of a listing.

    ``keys`` (default ``cands``) has the directories, at least those of ``cands``, whose depths are looked at.

    Returns manifest_row, _rep_files (ARRAY<STRUCT<uri,name>>), _rep_comment, _rep_vanish.
    """
    exp = cands.select("manifest_row", "run_id", "dir", F.posexplode("files").alias("pos", "f"))
    exp = exp.select("manifest_row", "run_id", "dir", "pos", F.col("f.path").alias("exp_path"),
                     F.col("f.uri").alias("exp_uri"), F.col("f.name").alias("exp_name"))
    exp = object_exists(exp, objects, "exp_path")

    # Mate index of the expected name: name.split('.')[0].split('_')[1] as an int.
    first = F.substring_index("exp_name", ".", 1)
    toks = F.split(F.regexp_replace(first, r"_+$", ""), "_")
    idx_txt = F.when(F.size(toks) >= 2, F.element_at(toks, 2))
    only_dots = F.col("exp_name").rlike(r"^\.+$")
    exp = exp.withColumn("idx", F.when(~only_dots, java_int(idx_txt)))

    # Objects under each ancestor directory that is as deep as some run's.
    name = file_name("path")
    head = F.substring_index(name, "_", 1)
    run_num = F.when(F.length(head) >= 4, java_int(F.expr("substring(substring_index(substring_index(path, '/', -1), '_', 1), 4)")))
    known = cands if keys is None else keys
    depths = known.where(F.col("dir").isNotNull()).select(F.sort_array(F.collect_set(depth_of("dir")))).scalar()
    under = (objects.select("path", F.explode(depths).alias("_depth")).where(depth_of("path") >= F.col("_depth"))
             .select("path", ancestor_at("path", F.col("_depth")).alias("adir"))
             .withColumn("rnum", run_num)
             .withColumn("has2", F.col("path").contains("_2"))
             .withColumn("has1", F.col("path").contains("_1")))
    dirs = cands.select(F.col("dir").alias("adir")).distinct()
    under = under.join(dirs, "adir", "left_semi")
    per_dir = under.groupBy("adir").agg(
        F.count("*").alias("n_dir"),
        F.min(F.when(F.col("has2"), F.col("path"))).alias("first2_any"),
        F.min(F.when(F.col("rnum").isNull(), F.col("path"))).alias("first_bad"),
        F.min("path").alias("first_any"))

    # Neighbour-run candidates: equi-join on (dir, run number ± 1).
    srun = java_int(F.expr("substring(run_id, 4)"))
    need = (exp.where(~F.col("exists") & (F.col("idx") == 2))
            .select("manifest_row", "dir", F.when(F.length("run_id") >= 4, srun).alias("s")))
    probes = need.where(F.col("s").isNotNull()).select(
        "manifest_row", "dir", F.explode(F.array(F.col("s").cast("bigint") - 1, F.col("s").cast("bigint") + 1)).alias("want"))
    neigh = (under.where(F.col("has2") & ~F.col("has1") & F.col("rnum").isNotNull())
             .select(F.col("adir").alias("dir"), F.col("rnum").cast("bigint").alias("want"), "path"))
    hits = (probes.join(neigh, ["dir", "want"])
            .groupBy("manifest_row").agg(F.min("path").alias("first_neigh")))

    exp = (exp.join(per_dir, exp["dir"] == per_dir["adir"], "left")
           .join(hits, "manifest_row", "left")
           .withColumn("s", F.when(F.length("run_id") >= 4, srun)))
    two = F.col("n_dir") == 2
    found_path = F.when(two, F.col("first2_any")).otherwise(F.col("first_neigh"))
    searching = ~F.col("exists") & (F.col("idx") == 2)
    # Parsing happens per object in name order until the first match (only when the
    # directory does not hold exactly two objects).
    vanish_search = searching & ~two & (
        F.col("s").isNull()
        | (F.col("first_bad").isNotNull() & (F.col("first_neigh").isNull() | (F.col("first_bad") < F.col("first_neigh")))))
    vanish = (~F.col("exists") & F.col("idx").isNull()) | vanish_search
    picked = F.when(F.col("exists"), F.struct(F.col("exp_uri").alias("uri"), F.col("exp_name").alias("name"))).when(
        searching & found_path.isNotNull(),
        F.struct(uri_of(root, found_path).alias("uri"), file_name(found_path).alias("name")))
    note = F.when(F.col("exists"), F.lit(None).cast("string")).when(
        F.col("idx") != 2, F.lit(ALREADY_TRIED)).when(found_path.isNull(), F.lit(FILE_NOT_FOUND))
    per_file = exp.select("manifest_row", "pos", vanish.alias("v"), picked.alias("picked"), note.alias("note"))
    # At most two rows per run (the expected files): a bounded gather.
    agg = per_file.groupBy("manifest_row").agg(
        F.sort_array(F.collect_list(F.struct("pos", "picked", "note"))).alias("_l"),
        F.max(F.col("v").cast("int")).alias("_v"))
    return agg.select(
        "manifest_row",
        F.transform(F.filter("_l", lambda x: x["picked"].isNotNull()), lambda x: x["picked"]).alias("_rep_files"),
        F.try_element_at(F.filter("_l", lambda x: x["note"].isNotNull()), F.lit(-1))["note"].alias("_rep_comment"),
        (F.col("_v") == 1).alias("_rep_vanish"))


def split_runs(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, anomalies).  Dropped runs are in neither."""
    return (classified.where(F.col("status") == "valid"), classified.where(F.col("status") == "anomaly"))


def anomaly_lines(classified: DataFrame) -> DataFrame:
    """R11 body: ``<comment>,<raw metadata line>`` per anomaly (null renders as ``null``)."""
    line = F.concat(F.coalesce(F.col("comment"), F.lit("null")), F.lit(","), F.coalesce(F.col("raw"), F.lit("null")))
    return classified.where(F.col("status") == "anomaly").select(line.alias("value"))


def write_anomalies(classified: DataFrame, path: str, single_file: bool = False) -> None:
    """Write the anomaly report as text; one file only on request (it funnels
    the whole report through one task)."""
    lines = anomaly_lines(classified)
    if single_file:
        lines = lines.coalesce(1)
    lines.write.mode("overwrite").text(path)


def anomaly_audit(classified: DataFrame, objects: DataFrame, mode: str = "prefix") -> DataFrame:
    """Centre, sample, run and the names of the objects seen for each
    wrong-count anomaly, as flat rows (one per object) so no run's list is
    gathered into one value."""
    bad = classified.where((F.col("status") == "anomaly") & (F.col("reason") == "wrong_count"))
    matched = match_run_files(bad.select("dir", "run_id"), objects, mode)
    return (bad.select("manifest_row", "center_name", "sample_id", "run_id", "dir")
            .join(matched, ["dir", "run_id"], "left")
            .select("manifest_row", "center_name", "sample_id", "run_id", F.col("path").alias("object_name")))
