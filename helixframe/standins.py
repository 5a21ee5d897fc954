"""Deterministic stand-in inputs derived from the driver's tables.

Each stand-in is one SQL text with ``{orders}`` / ``{part}`` / ``{customer}``
placeholders.  Spark runs it with ``spark.sql(text, orders=df, ...)`` (the
DataFrames are bound as arguments, no global views), and the DuckDB oracle gets
the same text with the placeholders replaced by the registered table names.
Every stand-in is a function of whole tables, so its size grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixframe.functions.partitioning import spread

TABLES = ("orders", "part", "customer")

# One run per order.  o_orderkey % 17 = 0 gets an instrument outside the known list.
MANIFEST = """
SELECT n, run_id, sample_id, study_id, layout, platform, center_name,
       concat(run_id, ',', sample_id, ',', study_id, ',', layout, ',', platform, ',', center_name) AS raw
FROM (
  SELECT o_orderkey AS n,
         concat('SRR', CAST(o_orderkey + 1000000 AS STRING)) AS run_id,
         concat('SRS', CAST(o_custkey + 100000 AS STRING)) AS sample_id,
         concat('SRP', CAST(o_custkey % 25 + 100000 AS STRING)) AS study_id,
         CASE WHEN o_orderkey % 3 = 0 THEN 'PAIRED' ELSE 'SINGLE' END AS layout,
         CASE WHEN o_orderkey % 17 = 0 THEN 'UNKNOWN_X' WHEN o_orderpriority = '1-URGENT' THEN 'LS454'
              ELSE 'ILLUMINA' END AS platform,
         concat('CTR', CAST(o_custkey % 7 AS STRING)) AS center_name
  FROM {orders}) m
"""

# The same rows with planted blanks, nulls and a lower-case layout for the required-field check.
MANIFEST_DIRTY = """
SELECT n,
       CASE WHEN n % 101 = 7 THEN '' ELSE run_id END AS run_id,
       CASE WHEN n % 97 = 5 THEN NULL ELSE sample_id END AS sample_id,
       CASE WHEN n % 89 = 3 THEN '  ' ELSE study_id END AS study_id,
       CASE WHEN n % 83 = 2 THEN NULL WHEN n % 79 = 1 THEN 'paired' WHEN n % 71 = 6 THEN 'TRIPLE'
            ELSE layout END AS layout,
       CASE WHEN n % 73 = 4 THEN '' ELSE platform END AS platform
FROM ({manifest}) d
"""

# The object listing.  n%11=0: last mate missing; n%13=0: extra _3; n%50=0: suffix lost;
# n%30=3: mate 2 stored under the next run id.
OBJECTS = """
WITH m AS (
  SELECT o.o_orderkey AS n, o.o_totalprice AS price,
         concat('fastq/SRP', CAST(o.o_custkey % 25 + 100000 AS STRING), '/SRS', CAST(o.o_custkey + 100000 AS STRING), '/') AS dir,
         CASE WHEN o.o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS n_expected
  FROM {orders} o),
mm AS (SELECT n, price, dir, n_expected, 1 AS mate FROM m
       UNION ALL SELECT n, price, dir, n_expected, 2 AS mate FROM m
       UNION ALL SELECT n, price, dir, n_expected, 3 AS mate FROM m)
SELECT concat(mm.dir, 'SRR', CAST(mm.n + 1000000 + CASE WHEN mm.n % 30 = 3 AND mm.mate = 2 THEN 1 ELSE 0 END AS STRING),
              CASE WHEN mm.n % 50 = 0 THEN '' ELSE concat('_', CAST(mm.mate AS STRING)) END, '.fastq') AS path,
       CAST(floor(mm.price) AS BIGINT) AS size
FROM mm
WHERE (mm.mate <= mm.n_expected AND NOT (mm.n % 11 = 0 AND mm.mate = mm.n_expected) AND NOT (mm.n % 50 = 0 AND mm.mate = 2))
   OR (mm.mate = 3 AND mm.n % 13 = 0 AND mm.n % 50 <> 0)
"""

# One 256-base contig per part, the whole part table.
CONTIGS = """
SELECT p_partkey AS contig_idx, concat('ctg', CAST(p_partkey AS STRING)) AS contig,
       translate(concat(md5(concat('a', CAST(p_partkey AS STRING))), md5(concat('b', CAST(p_partkey AS STRING))),
                        md5(concat('c', CAST(p_partkey AS STRING))), md5(concat('d', CAST(p_partkey AS STRING))),
                        md5(concat('e', CAST(p_partkey AS STRING))), md5(concat('f', CAST(p_partkey AS STRING))),
                        md5(concat('g', CAST(p_partkey AS STRING))), md5(concat('h', CAST(p_partkey AS STRING)))),
                 '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq
FROM {part}
"""

# One 64-base read per order (run), drawn from the contig of the order's customer, starting
# between 57 and 120 so every read covers base 120; half are reverse-complemented.  One planted
# substitution at base 120: contig%3=0 all reads carry it, contig%3=1 odd read ids, contig%3=2 none.
# true_* columns are the answer key.
READS = """
WITH h AS (
  SELECT contig_idx, seq,
         concat(substring(seq, 1, 119), translate(substring(seq, 120, 1), 'ACGT', 'CGTA'), substring(seq, 121, 136)) AS alt_seq
  FROM ({contigs}) c),
o AS (
  SELECT o_orderkey AS read_id, o_custkey, o_custkey AS contig_idx,
         CAST((o_orderkey * 37) % 64 + 57 AS INT) AS pos, CAST(floor(o_orderkey / 2) AS BIGINT) % 2 AS strand
  FROM {orders}),
f AS (
  SELECT o.read_id, o.o_custkey, o.contig_idx, o.pos, o.strand,
         substring(CASE WHEN o.contig_idx % 3 = 0 OR (o.contig_idx % 3 = 1 AND o.read_id % 2 = 1) THEN h.alt_seq ELSE h.seq END, o.pos, 64) AS fwd
  FROM o JOIN h ON o.contig_idx = h.contig_idx)
SELECT read_id,
       concat('SRR', CAST(read_id + 1000000 AS STRING)) AS run_id,
       concat('SRS', CAST(o_custkey + 100000 AS STRING)) AS sample_id,
       CASE WHEN strand = 1 THEN reverse(translate(fwd, 'ACGT', 'TGCA')) ELSE fwd END AS seq,
       translate(concat(md5(concat('q', CAST(read_id AS STRING))), md5(concat('r', CAST(read_id AS STRING)))),
                 '0123456789abcdef', '56789:;<=>?@ABCD') AS qual,
       contig_idx AS true_contig_idx, pos AS true_pos, strand AS true_strand
FROM f
"""

# FASTQ-style records per run and mate: k = o_orderkey % 4 + 1 records per mate, PAIRED runs
# have mate 2, and for n%11=0 the last mate-2 record is missing (an orphan).
READ_MATES = """
WITH m AS (
  SELECT o_orderkey AS n, CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS n_mates,
         o_orderkey % 4 + 1 AS k
  FROM {orders}),
mm AS (SELECT n, n_mates, k, 1 AS mate FROM m UNION ALL SELECT n, n_mates, k, 2 AS mate FROM m),
mo AS (SELECT n, n_mates, k, mate, 1 AS ordinal FROM mm UNION ALL SELECT n, n_mates, k, mate, 2 AS ordinal FROM mm
       UNION ALL SELECT n, n_mates, k, mate, 3 AS ordinal FROM mm UNION ALL SELECT n, n_mates, k, mate, 4 AS ordinal FROM mm)
SELECT concat('SRR', CAST(mo.n + 1000000 AS STRING)) AS run_id,
       mo.mate AS mate, CAST(mo.ordinal AS BIGINT) AS ordinal,
       concat('SRR', CAST(mo.n + 1000000 AS STRING), '.', CAST(mo.ordinal AS STRING)) AS name,
       translate(substring(md5(concat(CAST(mo.n AS STRING), '/', CAST(mo.mate AS STRING), '/', CAST(mo.ordinal AS STRING))), 1, 24),
                 '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq,
       translate(substring(md5(concat('q', CAST(mo.n AS STRING), '/', CAST(mo.mate AS STRING), '/', CAST(mo.ordinal AS STRING))), 1, 24),
                 '0123456789abcdef', '56789:;<=>?@ABCD') AS qual
FROM mo
WHERE mo.mate <= mo.n_mates AND mo.ordinal <= mo.k
  AND NOT (mo.n % 11 = 0 AND mo.mate = 2 AND mo.ordinal = mo.k)
"""

# What exists per stage, for the resume queries.  The reference name is 'ctg'.
STAGE_OBJECTS = """
SELECT 'align' AS stage, concat('result_aligned_bam/SRR', CAST(o_orderkey + 1000000 AS STRING), '_ctg') AS path,
       CAST(floor(o_totalprice) AS BIGINT) AS size FROM {orders} WHERE o_orderkey % 7 <> 0
UNION ALL
SELECT 'sort', concat('result_sorted_bam/SRR', CAST(o_orderkey + 1000000 AS STRING), '_ctg'),
       CAST(floor(o_totalprice) AS BIGINT) FROM {orders} WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0
UNION ALL
SELECT 'merge', concat('result_merged_bam/SRS', CAST(o_custkey + 100000 AS STRING), '_ctg'),
       CAST(floor(max(o_totalprice)) AS BIGINT) FROM {orders} WHERE o_custkey % 4 <> 0 GROUP BY o_custkey
UNION ALL
SELECT 'index', concat('result_merged_bam/SRS', CAST(o_custkey + 100000 AS STRING), '_ctg.idx'),
       CAST(1 AS BIGINT) FROM {orders} WHERE o_custkey % 4 <> 0 AND o_custkey % 6 <> 0 GROUP BY o_custkey
UNION ALL
SELECT 'dv', concat('result_dv/SRS', CAST(o_custkey + 100000 AS STRING), '_ctg/SRS', CAST(o_custkey + 100000 AS STRING), '_ctg.vcf'),
       CAST(o_custkey * 1000 AS BIGINT) FROM {orders} WHERE o_custkey % 4 <> 0 AND o_custkey % 6 <> 0 AND o_custkey % 5 <> 0 GROUP BY o_custkey
"""

# One JSON reference item per part; documents group ten consecutive parts (doc_key).
REFERENCE_JSON = """
SELECT CAST(floor(p_partkey / 10) AS BIGINT) AS doc_key, p_partkey AS contig_idx, concat('ctg', CAST(p_partkey AS STRING)) AS name,
       concat('{{"name":"ctg', CAST(p_partkey AS STRING), '","fastaUri":"gs://refs/ctg', CAST(p_partkey AS STRING),
              '/ctg', CAST(p_partkey AS STRING), '.fa","indexUri":"gs://refs/ctg', CAST(p_partkey AS STRING),
              '/ctg', CAST(p_partkey AS STRING), '.fa.fai"}}') AS item
FROM {part}
"""

_DEPENDS = {
    "manifest": ("orders",),
    "manifest_dirty": ("manifest",),
    "objects": ("orders",),
    "contigs": ("part",),
    "reads": ("contigs", "orders"),
    "read_mates": ("orders",),
    "stage_objects": ("orders",),
    "reference_json": ("part",),
}
_TEXT = {
    "manifest": MANIFEST, "manifest_dirty": MANIFEST_DIRTY, "objects": OBJECTS,
    "contigs": CONTIGS, "reads": READS, "read_mates": READ_MATES,
    "stage_objects": STAGE_OBJECTS, "reference_json": REFERENCE_JSON,
}


def sql_text(name: str) -> str:
    """DuckDB form: table placeholders become the registered view names,
    stand-in placeholders become nested sub-queries."""
    subs = {}
    for dep in _DEPENDS[name]:
        subs[dep] = dep if dep in TABLES else sql_text(dep)
    return _TEXT[name].format(**subs)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark form: same text, tables and stand-ins bound as DataFrame arguments."""
    args = {}
    for dep in _DEPENDS[name]:
        args[dep] = load_table(spark, sf_dir, dep) if dep in TABLES else standin(spark, sf_dir, dep)
    if name == "contigs":
        # A part is a few bytes in its file and a contig of many: a file that one task reads is made by all.
        args["part"] = spread(args["part"].select("p_partkey"))
    return spark.sql(_TEXT[name], **args)


def with_ctes(body: str, *names: str) -> str:
    """Oracle helper: ``WITH name AS (stand-in), ... body``."""
    ctes = ",\n".join(f"{n} AS ({sql_text(n)})" for n in names)
    return f"WITH {ctes}\n{body}"
