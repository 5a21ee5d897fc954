"""DuckDB oracle SQL for the registered queries (same column names as Spark).

The stand-ins are inlined as CTEs from :mod:`helixframe.standins`, so each
statement runs on the driver's pre-registered tables.  The oracle logic is
written independently of the Spark operators (e.g. prefix matching here is a
join on the parent directory with a ``starts_with`` residual).
"""

from __future__ import annotations

from helixframe.standins import with_ctes

ROOT = "gs://seq-runs/"


def _recon_ctes(mode: str = "prefix") -> str:
    if mode == "prefix":
        match = "o.dir = k.dir AND starts_with(o.path, k.dir || k.run_id)"
    else:
        match = "o.dir = k.dir AND regexp_extract(o.name, '^([^_.]*)', 1) = k.run_id"
    return f""",
mk AS (
  SELECT n AS manifest_row, run_id, sample_id, study_id, layout, platform, center_name, raw,
         CASE layout WHEN 'PAIRED' THEN 2 WHEN 'SINGLE' THEN 1 ELSE 0 END AS n_expected,
         concat('fastq/', study_id, '/', sample_id, '/') AS dir,
         coalesce(platform IN ('ILLUMINA', 'LS454'), false) AS gate
  FROM manifest),
op AS (
  SELECT path, size, regexp_extract(path, '^(.*/)', 1) AS dir, nm AS name,
         TRY_CAST(CASE WHEN regexp_full_match(sx, '[+-]?[0-9]+') THEN sx END AS INTEGER) AS suffix
  FROM (SELECT path, size, nm, split_part(regexp_extract(rtrim(nm, '_'), '[^_]*$', 0), '.', 1) AS sx
        FROM (SELECT path, size, regexp_extract(path, '[^/]*$', 0) AS nm FROM objects) o1) o2),
matched AS (
  SELECT k.dir, k.run_id, o.path, o.name, o.suffix
  FROM (SELECT DISTINCT dir, run_id FROM mk WHERE gate AND n_expected > 0) k
  JOIN op o ON {match}),
cnt AS (
  SELECT dir, run_id, count(*) AS n_found, count(*) FILTER (WHERE suffix IS NULL) AS n_bad,
         string_agg(name, ',' ORDER BY suffix, path) AS names
  FROM matched GROUP BY dir, run_id),
st AS (
  SELECT mk.*, CASE WHEN mk.gate AND mk.n_expected > 0 THEN CAST(coalesce(c.n_found, 0) AS INTEGER) END AS n_found,
         coalesce(c.n_bad, 0) AS n_bad, c.names
  FROM mk LEFT JOIN cnt c ON c.dir = mk.dir AND c.run_id = mk.run_id),
status AS (
  SELECT *,
    CASE WHEN run_id IS NULL THEN 'dropped' WHEN NOT gate THEN 'anomaly' WHEN n_expected = 0 THEN 'dropped'
         WHEN n_found <> n_expected THEN 'anomaly' WHEN n_bad > 0 THEN 'dropped' ELSE 'valid' END AS status,
    CASE WHEN run_id IS NULL THEN 'null_key' WHEN NOT gate THEN 'unknown_platform' WHEN n_expected = 0 THEN 'no_files'
         WHEN n_found <> n_expected THEN 'wrong_count' WHEN n_bad > 0 THEN 'bad_suffix' ELSE 'ok' END AS reason,
    CASE WHEN run_id IS NULL THEN NULL
         WHEN NOT gate THEN concat('Unknown INSTRUMENT: ', coalesce(platform, 'null'))
         WHEN n_expected = 0 THEN NULL
         WHEN n_found <> n_expected THEN concat('Wrong files number for runId (0/', CAST(n_expected AS VARCHAR), ')')
    END AS comment
  FROM st)
"""


def _recon(body: str, mode: str = "prefix") -> str:
    return with_ctes("", "manifest", "objects").rstrip() + _recon_ctes(mode) + body


ORACLE: dict[str, str] = {}

ORACLE["manifest_scan"] = with_ctes("""
SELECT run_id, sample_id, study_id, layout, platform, center_name,
       CASE WHEN n % 2 = 0 THEN '2011-10-12' ELSE '2014-07-17' END AS release_day
FROM manifest""", "manifest")

ORACLE["manifest_required"] = with_ctes("""
SELECT n, run_id, layout, reasons = '' AS ok, reasons FROM (
  SELECT n, nullif(trim(run_id), '') AS run_id, upper(nullif(trim(layout), '')) AS layout,
    concat_ws(';',
      CASE WHEN nullif(trim(run_id), '') IS NULL THEN 'missing:run_id' END,
      CASE WHEN nullif(trim(sample_id), '') IS NULL THEN 'missing:sample_id' END,
      CASE WHEN nullif(trim(study_id), '') IS NULL THEN 'missing:study_id' END,
      CASE WHEN nullif(trim(layout), '') IS NULL THEN 'missing:layout' END,
      CASE WHEN nullif(trim(platform), '') IS NULL THEN 'missing:platform' END,
      CASE WHEN nullif(trim(layout), '') IS NOT NULL AND upper(trim(layout)) NOT IN ('PAIRED', 'SINGLE')
           THEN 'bad:layout' END) AS reasons
  FROM manifest_dirty) t""", "manifest", "manifest_dirty")

ORACLE["manifest_quarantine"] = with_ctes("""
SELECT CASE WHEN n % 3 <> 0 THEN run_id END AS run_id, CASE WHEN n % 3 <> 0 THEN sample_id END AS sample_id,
       CASE WHEN n % 3 <> 0 THEN layout END AS layout,
       CASE WHEN n % 3 = 0 THEN concat(run_id, ',', sample_id, ',', study_id) END AS raw,
       CASE WHEN n % 3 = 0 THEN 'missing:run_id;missing:sample_id;missing:study_id;missing:layout;missing:platform' ELSE '' END AS reasons
FROM manifest""", "manifest")

ORACLE["filter_samples"] = with_ctes("""
SELECT n, run_id, sample_id FROM manifest
WHERE sample_id IN (SELECT concat('SRS', CAST(c_custkey + 100000 AS STRING)) FROM customer
                    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
  AND sample_id NOT IN (SELECT concat('SRS', CAST(c_custkey + 100000 AS STRING)) FROM customer WHERE c_nationkey = 3)""",
                                     "manifest")

ORACLE["expected_files"] = with_ctes(f"""
SELECT m.run_id, concat('fastq/', study_id, '/', sample_id, '/') AS dir, mates.mate AS mate,
       concat('{ROOT}fastq/', study_id, '/', sample_id, '/', run_id, '_', CAST(mates.mate AS STRING), '.fastq') AS uri,
       concat('fastq/', study_id, '/', sample_id, '/', run_id, '_', CAST(mates.mate AS STRING), '.fastq') AS path
FROM manifest m JOIN (SELECT 1 AS mate UNION ALL SELECT 2) mates
  ON mates.mate <= CASE m.layout WHEN 'PAIRED' THEN 2 WHEN 'SINGLE' THEN 1 ELSE 0 END""", "manifest")

ORACLE["group_by_sample"] = with_ctes("""
SELECT sample_id, count(*) AS n_runs, min(run_id) AS min_run, max(run_id) AS max_run,
       count(DISTINCT platform) AS n_platforms,
       CAST(sum(CASE layout WHEN 'PAIRED' THEN 2 WHEN 'SINGLE' THEN 1 ELSE 0 END) AS BIGINT) AS n_files
FROM manifest GROUP BY sample_id""", "manifest")

ORACLE["references_json"] = with_ctes("""
SELECT doc_key, name, concat('gs://refs/', name, '/', name, '.fa') AS fasta_uri,
       concat('gs://refs/', name, '/', name, '.fa.fai') AS index_uri
FROM reference_json
WHERE name IN (SELECT concat('ctg', CAST(c_custkey AS STRING)) FROM customer WHERE c_mktsegment = 'BUILDING')""",
                                      "reference_json")

ORACLE["parse_objects"] = _recon("SELECT path, dir, name, suffix, size FROM op")

ORACLE["match_prefix"] = _recon("""
SELECT k.dir, k.run_id, o.path FROM (SELECT DISTINCT dir, run_id FROM mk) k
JOIN op o ON o.dir = k.dir AND starts_with(o.path, k.dir || k.run_id)""")

ORACLE["match_exact"] = _recon("""
SELECT k.dir, k.run_id, o.path FROM (SELECT DISTINCT dir, run_id FROM mk) k
JOIN op o ON o.dir = k.dir AND regexp_extract(o.name, '^([^_.]*)', 1) = k.run_id""")

ORACLE["file_exists"] = _recon("""
SELECT e.run_id, e.mate, e.path, (o.path IS NOT NULL) AS present
FROM (SELECT mk.run_id, mates.mate,
             concat(mk.dir, mk.run_id, '_', CAST(mates.mate AS STRING), '.fastq') AS path
      FROM mk JOIN (SELECT 1 AS mate UNION ALL SELECT 2) mates ON mates.mate <= mk.n_expected) e
LEFT JOIN (SELECT DISTINCT path FROM objects) o ON o.path = e.path""")

_STATUS_SELECT = """
SELECT run_id, status, reason, comment, n_found, n_expected,
       CASE WHEN status = 'valid' THEN names END AS files
FROM status"""

ORACLE["run_status"] = _recon(_STATUS_SELECT)
ORACLE["run_status_exact"] = _recon(_STATUS_SELECT, mode="exact")

ORACLE["mate_order"] = _recon(f"""
SELECT s.run_id, CAST(row_number() OVER (PARTITION BY s.manifest_row ORDER BY m.suffix, m.path) AS INTEGER) AS mate_rank,
       m.name, concat('{ROOT}', m.path) AS uri
FROM status s JOIN matched m ON m.dir = s.dir AND m.run_id = s.run_id
WHERE s.status = 'valid'""")

ORACLE["anomaly_lines"] = _recon("""
SELECT concat(coalesce(comment, 'null'), ',', coalesce(raw, 'null')) AS value FROM status WHERE status = 'anomaly'""")

ORACLE["anomaly_audit"] = _recon("""
SELECT s.center_name, s.sample_id, s.run_id, m.path AS object_name
FROM status s LEFT JOIN matched m ON m.dir = s.dir AND m.run_id = s.run_id
WHERE s.status = 'anomaly' AND s.reason = 'wrong_count'""")

ORACLE["run_status_counts"] = _recon("""
SELECT status, reason, count(*) AS n_runs FROM status GROUP BY status, reason""")

ORACLE["repair_mate2"] = _recon(r""",
cand AS (SELECT * FROM status WHERE gate AND n_expected = 2 AND n_found = 1),
exp AS (
  SELECT c.manifest_row, c.run_id, c.dir, mates.mate AS pos,
         concat(c.dir, c.run_id, '_', CAST(mates.mate AS VARCHAR), '.fastq') AS exp_path,
         concat(c.run_id, '_', CAST(mates.mate AS VARCHAR), '.fastq') AS exp_name
  FROM cand c CROSS JOIN (SELECT 1 AS mate UNION ALL SELECT 2) mates),
exp2 AS (
  SELECT e.*, (o.path IS NOT NULL) AS present,
         TRY_CAST(CASE WHEN regexp_full_match(split_part(split_part(e.exp_name, '.', 1), '_', 2), '[+-]?[0-9]+')
                       THEN split_part(split_part(e.exp_name, '.', 1), '_', 2) END AS INTEGER) AS idx,
         TRY_CAST(CASE WHEN regexp_full_match(substr(e.run_id, 4), '[+-]?[0-9]+') THEN substr(e.run_id, 4) END AS BIGINT) AS s
  FROM exp e LEFT JOIN (SELECT DISTINCT path FROM objects) o ON o.path = e.exp_path),
under AS (
  SELECT c.manifest_row, c.run_id, o.path, contains(o.path, '_2') AS has2, contains(o.path, '_1') AS has1,
         TRY_CAST(CASE WHEN length(split_part(o.name, '_', 1)) >= 4
                        AND regexp_full_match(substr(split_part(o.name, '_', 1), 4), '[+-]?[0-9]+')
                       THEN substr(split_part(o.name, '_', 1), 4) END AS BIGINT) AS rnum
  FROM cand c JOIN op o ON starts_with(o.path, c.dir)),
dirstat AS (
  SELECT u.manifest_row, count(*) AS n_dir,
         min(u.path) FILTER (WHERE u.has2) AS first2_any,
         min(u.path) FILTER (WHERE u.rnum IS NULL) AS first_bad,
         min(u.path) FILTER (WHERE u.has2 AND NOT u.has1 AND u.rnum IS NOT NULL
                             AND abs(u.rnum - TRY_CAST(substr(u.run_id, 4) AS BIGINT)) = 1) AS first_neigh
  FROM under u GROUP BY u.manifest_row),
per_file AS (
  SELECT e.manifest_row, e.pos,
         CASE WHEN e.present THEN e.exp_path
              WHEN e.idx = 2 THEN (CASE WHEN d.n_dir = 2 THEN d.first2_any ELSE d.first_neigh END) END AS picked,
         CASE WHEN e.present THEN NULL
              WHEN e.idx <> 2 THEN 'Already tried with _1 paired index'
              WHEN e.idx = 2 AND (CASE WHEN d.n_dir = 2 THEN d.first2_any ELSE d.first_neigh END) IS NULL THEN 'File not found'
         END AS note,
         (NOT e.present AND e.idx IS NULL)
         OR (NOT e.present AND e.idx = 2 AND d.n_dir <> 2
             AND (e.s IS NULL OR (d.first_bad IS NOT NULL AND (d.first_neigh IS NULL OR d.first_bad < d.first_neigh)))) AS vanish
  FROM exp2 e JOIN dirstat d ON d.manifest_row = e.manifest_row),
rep AS (
  SELECT manifest_row, count(picked) AS k, bool_or(vanish) AS vanish,
         string_agg(regexp_extract(picked, '[^/]*$', 0), ',' ORDER BY pos) AS names,
         arg_max(note, pos) FILTER (WHERE note IS NOT NULL) AS last_note
  FROM per_file GROUP BY manifest_row)
SELECT s.run_id,
       CASE WHEN r.manifest_row IS NULL THEN s.status WHEN r.vanish THEN 'dropped' WHEN r.k = 2 THEN 'valid' ELSE 'anomaly' END AS status,
       CASE WHEN r.manifest_row IS NULL THEN s.reason WHEN r.vanish THEN 'bad_repair_number' WHEN r.k = 2 THEN 'repaired'
            ELSE 'repair_failed' END AS reason,
       CASE WHEN r.manifest_row IS NULL THEN s.comment WHEN r.vanish OR r.k = 2 THEN NULL
            ELSE concat(coalesce(r.last_note, 'null'), ' (', CAST(r.k AS VARCHAR), '/2)') END AS comment,
       s.n_found, s.n_expected,
       CASE WHEN r.manifest_row IS NULL THEN (CASE WHEN s.status = 'valid' THEN s.names END)
            WHEN r.k = 2 AND NOT r.vanish THEN r.names END AS files
FROM status s LEFT JOIN rep r ON r.manifest_row = s.manifest_row""")


def _resume(body: str) -> str:
    return with_ctes("", "manifest", "stage_objects").rstrip() + """,
refs AS (SELECT 'ctg' AS reference UNION ALL SELECT 'alt'),
present AS (SELECT path, max(size) AS size FROM stage_objects GROUP BY path),
rf AS (
  SELECT m.run_id, m.sample_id, r.reference,
         concat('result_aligned_bam/', m.run_id, '_', r.reference) AS align_path,
         concat('result_sorted_bam/', m.run_id, '_', r.reference) AS sort_path,
         EXISTS (SELECT 1 FROM present p WHERE p.path = concat('result_aligned_bam/', m.run_id, '_', r.reference)) AS aligned,
         EXISTS (SELECT 1 FROM present p WHERE p.path = concat('result_sorted_bam/', m.run_id, '_', r.reference)) AS sorted
  FROM manifest m CROSS JOIN refs r),
sf0 AS (
  SELECT sample_id, reference, count(*) AS n_runs, count(*) FILTER (WHERE aligned) AS n_aligned,
         count(*) FILTER (WHERE sorted) AS n_sorted,
         concat('result_merged_bam/', sample_id, '_', reference) AS merge_path,
         concat('result_merged_bam/', sample_id, '_', reference, '.idx') AS index_path,
         concat('result_dv/', sample_id, '_', reference, '/', sample_id, '_', reference, '.vcf') AS dv_path
  FROM rf GROUP BY sample_id, reference),
sf AS (
  SELECT sf0.*, pm.size AS merged_size, pm.path IS NOT NULL AS merged,
         EXISTS (SELECT 1 FROM present p WHERE p.path = sf0.index_path) AS indexed,
         EXISTS (SELECT 1 FROM present p WHERE p.path = sf0.dv_path) AS called
  FROM sf0 LEFT JOIN present pm ON pm.path = sf0.merge_path)
""" + body


ORACLE["pending_align"] = _resume("SELECT run_id, reference, align_path FROM rf WHERE NOT aligned")
ORACLE["pending_sort"] = _resume("SELECT run_id, reference, sort_path FROM rf WHERE aligned AND NOT sorted")
ORACLE["pending_merge"] = _resume("SELECT sample_id, reference, n_runs, n_sorted FROM sf WHERE n_sorted = n_runs AND NOT merged")
ORACLE["pending_index"] = _resume("SELECT sample_id, reference, index_path FROM sf WHERE merged AND NOT indexed")
ORACLE["pending_dv"] = _resume("""
SELECT sample_id, reference, merged_size, dv_path FROM sf
WHERE indexed AND NOT called AND merged_size >= 100000 AND merged_size <= 450000""")
_COMPLETE = "(n_aligned = n_runs AND n_sorted = n_runs AND merged AND indexed AND called)"
ORACLE["completion"] = _resume(f"""
SELECT sample_id, reference, n_runs, n_aligned, n_sorted, merged, indexed, called, {_COMPLETE} AS complete FROM sf""")
ORACLE["completion_csv"] = _resume(f"""
SELECT concat_ws(',', sample_id, reference, CAST(n_runs AS VARCHAR), CAST(n_aligned AS VARCHAR), CAST(n_sorted AS VARCHAR),
                 CAST(merged AS VARCHAR), CAST(indexed AS VARCHAR), CAST(called AS VARCHAR),
                 CAST({_COMPLETE} AS VARCHAR)) AS value FROM sf""")

ORACLE["vcf_batches"] = with_ctes("""
SELECT path, row_number() OVER (ORDER BY path) AS file_rank,
       CAST(floor((row_number() OVER (ORDER BY path) - 1) / 50) AS BIGINT) AS batch
FROM stage_objects WHERE stage = 'dv'""", "stage_objects")

ORACLE["export_ledger"] = with_ctes("""
SELECT path, reference, concat('variants_', reference) AS table_name,
       row_number() OVER (ORDER BY path) AS file_rank,
       CAST(floor((row_number() OVER (ORDER BY path) - 1) / 50) AS BIGINT) AS batch
FROM (SELECT path, regexp_extract(regexp_extract(path, '([^/]*)\\.vcf$', 1), '^[^_]*_(.*)$', 1) AS reference
      FROM stage_objects
      WHERE stage = 'dv'
        AND CAST(substr(regexp_extract(path, '/(SRS[0-9]+)_', 1), 4) AS BIGINT) % 3 <> 0) p""", "stage_objects")

_FASTQ_FILES = """
SELECT *, row_number() OVER (PARTITION BY block ORDER BY run_id, mate, ordinal) AS number
FROM (SELECT *, CAST(substr(run_id, 4) AS BIGINT) - 1000000 AS n,
             CAST(floor((CAST(substr(run_id, 4) AS BIGINT) - 1000000) / 2000) AS BIGINT) AS block FROM read_mates) r"""

ORACLE["fastq_scan"] = with_ctes(f"""
SELECT block, number AS ordinal, run_id, mate, ordinal AS read, seq, qual, false AS malformed FROM ({_FASTQ_FILES}) f""",
                                 "read_mates")
ORACLE["fastq_gz_scan"] = ORACLE["fastq_scan"]
ORACLE["fastq_malformed"] = with_ctes(f"""
SELECT scan, block, number AS ordinal, CASE WHEN NOT bad THEN run_id END AS run_id, CASE WHEN NOT bad THEN mate END AS mate,
       CASE WHEN NOT bad THEN ordinal END AS read, CASE WHEN NOT bad THEN seq END AS seq,
       CASE WHEN bad THEN concat('@', name, '/', CAST(mate AS STRING), chr(10), seq, chr(10), '+', chr(10), qual, '@') ELSE qual END AS qual,
       bad AS malformed
FROM (SELECT *, n % 37 = 5 AND mate = 1 AND ordinal = 1 AS bad FROM ({_FASTQ_FILES}) f) g
CROSS JOIN (SELECT unnest(['small', 'large', 'table']) AS scan) s""", "read_mates")

ORACLE["mate_pairs"] = with_ctes("""
SELECT run_id, ordinal, copy,
       CASE WHEN copy > 1 THEN 'duplicate' WHEN count(*) = 2 THEN 'paired' WHEN max(mate) = 1 THEN 'orphan_1' ELSE 'orphan_2' END AS status,
       max(seq) FILTER (WHERE mate = 1) AS seq1, max(seq) FILTER (WHERE mate = 2) AS seq2
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY run_id, ordinal, mate ORDER BY name DESC, seq DESC, qual DESC) AS INT) AS copy
      FROM (SELECT run_id, ordinal, mate, name, qual,
                   unnest(CASE WHEN mate = 1 AND ordinal % 3 = 0 THEN [seq, reverse(seq)] ELSE [seq] END) AS seq FROM read_mates) r) x
GROUP BY run_id, ordinal, copy""", "read_mates")

ORACLE["read_chunks"] = with_ctes("""
SELECT r.run_id, r.mate, r.ordinal,
       CAST(CASE WHEN coalesce(s.run_bytes, 0) > 400000 THEN floor((r.ordinal - 1) / 2) ELSE 0 END AS BIGINT) AS chunk
FROM read_mates r
LEFT JOIN (SELECT regexp_extract(path, '/(SRR[0-9]+)[^/]*$', 1) AS run_id, sum(size) AS run_bytes
           FROM objects GROUP BY 1) s ON s.run_id = r.run_id""", "read_mates", "objects")

ORACLE["fasta_scan"] = with_ctes("""
SELECT c.contig, t.tile, t.tile * 100 AS start, substring(c.seq, CAST(t.tile * 100 + 1 AS INTEGER), 120) AS seq
FROM contigs c JOIN (SELECT CAST(range AS BIGINT) AS tile FROM range(0, 3)) t ON t.tile * 100 < length(c.seq)""",
                                 "contigs")

ORACLE["fasta_gz_scan"] = ORACLE["fasta_scan"]

ORACLE["fasta_index"] = with_ctes("""
SELECT contig, CAST(length(seq) AS BIGINT) AS length, 60 AS linebases, 61 AS linewidth FROM contigs""", "contigs")


_ALIGN_CTES = """,
idx AS (
  SELECT contig_idx, pos, kmer, count(*) OVER (PARTITION BY kmer) AS occ
  FROM (SELECT contig_idx, pos, substring(seq, CAST(pos + 1 AS INTEGER), 15) AS kmer
        FROM (SELECT contig_idx, seq, unnest(range(0, length(seq) - 14)) AS pos FROM contigs) x) ck
  WHERE regexp_full_match(kmer, '[ACGT]{15}')),
oriented AS (
  SELECT read_id, 0 AS strand, seq AS s FROM reads
  UNION ALL SELECT read_id, 1 AS strand, reverse(translate(seq, 'ACGT', 'TGCA')) AS s FROM reads),
votes AS (
  SELECT rk.read_id, idx.contig_idx, rk.strand, idx.pos - rk.j AS start, count(*) AS votes
  FROM (SELECT read_id, strand, j, substring(s, CAST(j + 1 AS INTEGER), 15) AS kmer
        FROM (SELECT read_id, strand, s, unnest(range(0, length(s) - 14, 15)) AS j FROM oriented) x) rk
  JOIN idx ON rk.kmer = idx.kmer AND idx.occ <= 1
  GROUP BY rk.read_id, idx.contig_idx, rk.strand, idx.pos - rk.j),
vagg AS (
  SELECT read_id, max(votes) AS votes, coalesce(list_sort(list(votes), 'DESC')[2], 0) AS second_votes
  FROM votes GROUP BY read_id),
pick AS (
  SELECT read_id, contig_idx, start, strand FROM (
    SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY votes DESC, contig_idx, start, strand) AS rn FROM votes) v
  WHERE rn = 1),
hits AS (
  SELECT p.read_id, p.contig_idx, p.start, p.strand, a.votes, a.second_votes,
         CAST(floor(60 * (a.votes - a.second_votes) / a.votes) AS INTEGER) AS mapq
  FROM pick p JOIN vagg a ON a.read_id = p.read_id),
al0 AS (
  SELECT r.read_id, r.seq AS rseq, r.qual AS rqual, r.run_id, r.sample_id, r.true_contig_idx, r.true_pos, r.true_strand,
         h.contig_idx, h.start, h.strand, h.mapq, h.votes, h.second_votes, h.votes = h.second_votes AS repeated,
         CASE WHEN h.strand = 1 THEN reverse(translate(r.seq, 'ACGT', 'TGCA')) ELSE r.seq END AS aseq,
         substring(c.seq, CAST(h.start + 1 AS INTEGER), length(r.seq)) AS refseq, length(c.seq) AS clen
  FROM reads r LEFT JOIN hits h ON h.read_id = r.read_id LEFT JOIN contigs c ON c.contig_idx = h.contig_idx),
al1 AS (
  SELECT *, CASE WHEN start >= 0 AND start + length(aseq) <= clen THEN hamming(aseq, refseq) END AS mm FROM al0),
lost AS (SELECT read_id FROM al1 WHERE coalesce(mm, 99) > 4),
places AS (
  SELECT l.read_id, l.strand, l.s, idx.contig_idx, idx.pos - l.j AS start,
         min(CASE WHEN occ <= 1 THEN 0 WHEN occ <= 64 THEN 1 WHEN occ <= 4096 THEN 2 WHEN occ <= 262144 THEN 3 ELSE 4 END) AS class
  FROM (SELECT read_id, strand, s, j, substring(s, CAST(j + 1 AS INTEGER), 15) AS kmer
        FROM (SELECT read_id, strand, s, unnest(range(0, length(s) - 14)) AS j FROM oriented WHERE read_id IN (SELECT read_id FROM lost)) x) l
  JOIN idx ON l.kmer = idx.kmer GROUP BY ALL),
near AS (
  SELECT * FROM (
    SELECT p.*, CASE WHEN start >= 0 AND start + length(s) <= length(c.seq) THEN hamming(s, substring(c.seq, CAST(start + 1 AS INTEGER), length(s))) END AS mm
    FROM places p JOIN contigs c ON c.contig_idx = p.contig_idx) x
  WHERE mm <= 4),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY class, mm, contig_idx, start, strand) AS rn,
         count(*) OVER (PARTITION BY read_id, class, mm) AS n_same,
         lead(mm) OVER (PARTITION BY read_id, class ORDER BY mm, contig_idx, start, strand) AS next_mm
  FROM near),
rescued AS (
  SELECT read_id, contig_idx, start, strand, n_same > 1 AS repeated,
         CASE WHEN n_same > 1 THEN 0 ELSE CAST(floor(60 * (coalesce(next_mm, 5) - mm) / 5) AS INTEGER) END AS mapq
  FROM placed WHERE rn = 1),
al2 AS (
  SELECT a.read_id, rseq, rqual, run_id, sample_id, true_contig_idx, true_pos, true_strand,
         CASE WHEN mm <= 4 THEN a.contig_idx ELSE r.contig_idx END AS hc, CASE WHEN mm <= 4 THEN a.start ELSE r.start END AS start,
         CASE WHEN mm <= 4 THEN a.strand ELSE r.strand END AS hs, CASE WHEN mm <= 4 THEN a.mapq ELSE coalesce(r.mapq, 0) END AS mapq,
         CASE WHEN mm <= 4 THEN votes ELSE 0 END AS votes, CASE WHEN mm <= 4 THEN second_votes ELSE 0 END AS second_votes,
         CASE WHEN mm <= 4 THEN a.repeated ELSE coalesce(r.repeated, false) END AS repeated
  FROM al1 a LEFT JOIN rescued r ON r.read_id = a.read_id),
al3 AS (
  SELECT a.*, c.contig, CASE WHEN hs = 1 THEN reverse(translate(rseq, 'ACGT', 'TGCA')) ELSE rseq END AS aseq,
         CASE WHEN hs = 1 THEN reverse(rqual) ELSE rqual END AS aqual, substring(c.seq, CAST(start + 1 AS INTEGER), length(rseq)) AS refseq
  FROM al2 a LEFT JOIN contigs c ON c.contig_idx = hc),
aln AS (
  SELECT read_id, run_id, sample_id, true_contig_idx, true_pos, true_strand, 'ctg' AS reference,
         hc AS contig_idx, contig, CAST(start + 1 AS BIGINT) AS pos, hs AS strand,
         CASE WHEN hc IS NULL THEN 4 WHEN hs = 1 THEN 16 ELSE 0 END AS flag,
         CASE WHEN hc IS NOT NULL THEN concat(CAST(length(aseq) AS VARCHAR), 'M') END AS cigar,
         mapq, votes, second_votes, repeated AS repeat, CASE WHEN hc IS NOT NULL THEN hamming(aseq, refseq) END AS nm,
         aseq AS seq, aqual AS qual, refseq AS ref_seq
  FROM al3)
"""


def _align(body: str) -> str:
    """Seed-and-vote mapping and ungapped verification over whole contigs (k = 15, rare read seeds every 15
    bases, then every seed of the reads not placed, by class of frequency, max_mm = 4), string k-mers instead
    of codes."""
    return with_ctes("", "contigs", "reads").rstrip() + _ALIGN_CTES + body


ORACLE["kmer_index"] = _align("""
SELECT contig_idx, count(*) AS n_kmers, sum(pos) AS sum_pos, count(*) FILTER (WHERE occ > 1) AS n_frequent,
       coalesce(sum(occ) FILTER (WHERE occ > 1), 0) AS sum_occ
FROM idx GROUP BY contig_idx""")
ORACLE["map_reads"] = _align("""
SELECT read_id, contig_idx, pos - 1 AS start, strand, votes, second_votes, mapq, repeat FROM aln""")
ORACLE["map_repeats"] = (ORACLE["map_reads"].replace(_ALIGN_CTES, """,
twice AS (SELECT contig_idx, contig, CASE WHEN contig_idx % 2 = 0 THEN seq || seq ELSE seq END AS seq FROM contigs)"""
                         + _ALIGN_CTES.replace("FROM contigs", "FROM twice").replace("JOIN contigs c", "JOIN twice c")))
ORACLE["verify_hits"] = _align("""
SELECT read_id, contig_idx, pos, strand, flag, cigar, nm, mapq, repeat,
       coalesce(contig_idx = true_contig_idx AND pos = true_pos AND strand = true_strand, false) AS correct
FROM aln""")
ORACLE["sorted_alignments"] = _align("""
SELECT read_id, row_number() OVER (ORDER BY reference, contig_idx NULLS LAST, pos NULLS LAST, strand NULLS FIRST, read_id)
       AS sort_rank, contig_idx, pos FROM aln""")
ORACLE["region_merge"] = _align("""
SELECT read_id, row_number() OVER (ORDER BY reference, contig_idx NULLS LAST, pos NULLS LAST, strand NULLS FIRST, read_id)
       AS row_number, contig_idx, pos FROM aln""")
ORACLE["merged_runs"] = _align("""
SELECT sample_id, reference, count(*) AS n_reads, count(DISTINCT run_id) AS n_read_groups, count(pos) AS n_mapped,
       min(pos) AS min_pos, max(pos) AS max_pos FROM aln GROUP BY sample_id, reference""")
ORACLE["regions"] = _align("""
SELECT contig_idx, CAST(floor((pos - 1) / 50) AS BIGINT) AS region, count(*) AS n_reads
FROM aln WHERE pos IS NOT NULL GROUP BY ALL""")
ORACLE["window_index"] = _align("""
SELECT contig_idx, CAST(floor((pos - 1) / 64) AS BIGINT) AS window, count(*) AS n_reads, min(pos) AS min_pos,
       max(pos) AS max_pos, max(pos + length(seq) - 1) AS max_end
FROM aln WHERE pos IS NOT NULL GROUP BY ALL""")
ORACLE["region_query"] = _align("""
SELECT read_id, pos FROM aln WHERE contig = 'ctg3' AND pos <= 130 AND pos + length(seq) - 1 >= 100""")
ORACLE["overlap"] = _align("""
SELECT a.read_id, r.contig, r.region_start, r.region_end
FROM aln a JOIN (SELECT contig, CAST(110 AS BIGINT) AS region_start, CAST(130 AS BIGINT) AS region_end FROM contigs
                 UNION ALL
                 SELECT contig, CAST(200 AS BIGINT), CAST(length(seq) AS BIGINT) FROM contigs) r
  ON a.contig = r.contig AND a.pos <= r.region_end AND r.region_start <= a.pos + length(a.seq) - 1
WHERE a.pos IS NOT NULL""")

_PILEUP = """,
pu0 AS (
  SELECT sample_id, contig_idx, contig, pos + i - 1 AS p, strand,
         substring(ref_seq, CAST(i AS INTEGER), 1) AS ref, substring(seq, CAST(i AS INTEGER), 1) AS base,
         ascii(substring(qual, CAST(i AS INTEGER), 1)) - 33 AS q
  FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM aln WHERE pos IS NOT NULL) x),
pu AS (
  SELECT sample_id, contig_idx, contig, p AS pos, ref, base, count(*) AS n,
         count(*) FILTER (WHERE strand = 0) AS n_fwd, count(*) FILTER (WHERE strand = 1) AS n_rev, sum(q) AS qual_sum
  FROM pu0 GROUP BY ALL),
site AS (
  SELECT sample_id, contig_idx, contig, pos, min(ref) AS ref, sum(n) AS depth,
         sum(CASE WHEN base = ref THEN n ELSE 0 END) AS ref_count,
         arg_min(base, (-n, base)) FILTER (WHERE base <> ref) AS alt,
         coalesce(max(n) FILTER (WHERE base <> ref), 0) AS alt_count
  FROM pu GROUP BY sample_id, contig_idx, contig, pos),
calls AS (
  SELECT *, CASE WHEN depth < 4 THEN './.' WHEN 10 * alt_count >= 8 * depth THEN '1/1'
                 WHEN 10 * alt_count >= 2 * depth THEN '0/1' ELSE '0/0' END AS genotype
  FROM site WHERE alt_count > 0)
"""

ORACLE["pileup"] = _align(_PILEUP + """
SELECT sample_id, contig_idx, pos, ref, base, n, n_fwd, n_rev, qual_sum FROM pu""")
ORACLE["genotypes"] = _align(_PILEUP + """
SELECT sample_id, contig, pos, ref, alt, depth, ref_count, alt_count, genotype FROM calls""")
ORACLE["vcf_roundtrip"] = _align(_PILEUP + """
SELECT sample_id, contig, pos, ref, alt, genotype, CAST(depth AS INTEGER) AS depth FROM calls""")
ORACLE["variants_flat"] = _align(_PILEUP + """
SELECT contig AS reference_name, pos - 1 AS start, pos - 1 + length(ref) AS "end", ref AS reference_bases, alt,
       sample_id AS call_set_name,
       concat_ws('/', CASE WHEN genotype LIKE '1%' THEN '1' WHEN genotype LIKE '.%' THEN '-1' ELSE '0' END,
                      CASE WHEN genotype LIKE '%1' THEN '1' WHEN genotype LIKE '%.' THEN '-1' ELSE '0' END) AS genotype
FROM calls""")

ORACLE["exported_rows"] = ORACLE["variants_flat"]
ORACLE["manifest_stream"] = ORACLE["run_status"]
ORACLE["genotypes_pileup"] = ORACLE["genotypes"]


# J1-J4 over the stand-ins: valid runs' reads aligned and called; completion of the outputs.
_JOB_ALIGN = _ALIGN_CTES.replace(
    "FROM reads r LEFT JOIN hits h ON h.read_id = r.read_id",
    "FROM (SELECT * FROM reads WHERE run_id IN (SELECT run_id FROM status WHERE status = 'valid')) r "
    "LEFT JOIN hits h ON h.read_id = r.read_id")
ORACLE["job_completion"] = (with_ctes("", "manifest", "objects", "contigs", "reads").rstrip() + _recon_ctes()
                            + _JOB_ALIGN + _PILEUP + """,
vr AS (SELECT sample_id, count(*) AS n_runs FROM status WHERE status = 'valid' GROUP BY sample_id),
ar AS (SELECT sample_id, count(DISTINCT run_id) AS n, count(pos) AS n_mapped FROM aln GROUP BY sample_id)
SELECT vr.sample_id, 'ctg' AS reference, vr.n_runs, coalesce(ar.n, 0) AS n_aligned, coalesce(ar.n, 0) AS n_sorted,
       ar.n IS NOT NULL AS merged, ar.n IS NOT NULL AS indexed, ar.n IS NOT NULL AS called,
       coalesce(ar.n = vr.n_runs, false) AS complete
FROM vr LEFT JOIN ar ON ar.sample_id = vr.sample_id""")
ORACLE["finalise_modes"] = (with_ctes("", "manifest", "objects", "contigs", "reads").rstrip() + _recon_ctes()
                            + _JOB_ALIGN + _PILEUP + """
SELECT a.sample_id, count(*) AS n_reads, count(DISTINCT run_id) AS n_runs, count(pos) AS n_mapped, count(pos) AS n_indexed,
       coalesce(any_value(c.n), 0) AS n_exported
FROM aln a LEFT JOIN (SELECT sample_id, count(*) AS n FROM calls GROUP BY sample_id) c ON c.sample_id = a.sample_id
GROUP BY a.sample_id""")
ORACLE["job_reads"] = (with_ctes("", "manifest", "objects", "read_mates").rstrip() + _recon_ctes() + """,
r AS (SELECT m.*, v.sample_id, v.layout, run_id || '/' || mate || '/' || ordinal AS read_id,
             count(*) OVER (PARTITION BY run_id, ordinal) AS n_here, sum(length(seq) + length(qual)) OVER (PARTITION BY run_id) AS run_bytes
      FROM read_mates m JOIN (SELECT DISTINCT run_id, sample_id, layout FROM status WHERE status = 'valid') v USING (run_id))
SELECT run_id, sample_id, CAST(CASE WHEN run_bytes > 100 THEN floor((ordinal - 1) / 2) ELSE 0 END AS BIGINT) AS chunk,
       CASE WHEN n_here = 2 THEN 'paired' WHEN layout = 'SINGLE' THEN 'single' WHEN mate = 1 THEN 'orphan_1' ELSE 'orphan_2' END AS pair_status,
       count(*) AS n_reads, CAST(sum(CAST('0x' || substring(md5(read_id || '/' || seq || '/' || qual), 1, 8) AS BIGINT)) AS BIGINT) AS content
FROM r GROUP BY ALL""")
