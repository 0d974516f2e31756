"""Reads, run files and sample tables derived from the star-schema tables.

Each text is SQL that both Spark and DuckDB run as it stands; `{orders}` and the like stand for the base table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

READS = """
WITH k AS (SELECT o_orderkey AS k, o_orderkey - CASE WHEN o_orderkey % 8 = 4 THEN 4 ELSE 0 END AS t FROM {orders}),
n AS (SELECT 1 AS n UNION ALL SELECT 2 AS n),
b AS (SELECT k, t, n, k % 10 <> 0 AS paired, k % 7 = 0 AS um1, k % 11 = 0 AS um2,
  CASE WHEN k % 19 = 0 THEN 'gi|9626372|ref|NC_001422.1|' ELSE concat('chr', CAST(1 + t % 5 AS STRING)) END AS ref1,
  1000 + (t * 37) % 100000 AS pos1, 200 + (t * t) % 97 AS ins,
  translate(concat(md5(concat(CAST(t AS STRING), '-', CAST(n AS STRING))), md5(concat(CAST(t AS STRING), '+', CAST(n AS STRING)))), '0123456789abcdef', 'ACGTACGTACGTACGN') AS s0,
  translate(concat(md5(concat(CAST(k AS STRING), 'q', CAST(n AS STRING))), md5(concat(CAST(k AS STRING), 'Q', CAST(n AS STRING)))), '0123456789abcdef', '!+5:<>?ABCDEFGHI') AS qual
  FROM k CROSS JOIN n WHERE k % 10 <> 0 OR n = 1),
c AS (SELECT *, CASE WHEN n = 1 THEN um1 ELSE um2 END AS unmapped, CASE WHEN n = 1 THEN um2 ELSE um1 END AS mate_unmapped_raw,
  CASE WHEN k % 23 = 0 THEN 'chr9' ELSE ref1 END AS ref2,
  CASE WHEN k % 6 = 1 THEN n = 1 WHEN k % 20 = 3 THEN false ELSE n = 2 END AS neg,
  CASE WHEN k % 6 = 1 THEN n = 2 WHEN k % 20 = 3 THEN false ELSE n = 1 END AS mate_neg_raw,
  CASE WHEN k % 17 = 0 THEN concat('NNNNNNNNNNNN', substr(s0, 13))
       WHEN k % 13 = 0 THEN concat(substr(s0, 1, CAST(k % 50 AS INT)), 'GATCGGAA', substr(s0, CAST(k % 50 AS INT) + 9)) ELSE s0 END AS seq
  FROM b)
SELECT concat('r', CAST(k AS STRING)) AS qname, CAST(n AS INT) AS read_no, paired, unmapped,
  paired AND mate_unmapped_raw AS mate_unmapped, neg, paired AND mate_neg_raw AS mate_neg,
  (NOT unmapped) AND k % 8 = 4 AS dup, false AS not_primary,
  CASE WHEN unmapped THEN '*' WHEN n = 1 THEN ref1 ELSE ref2 END AS rname,
  CASE WHEN unmapped THEN 0 WHEN n = 1 THEN pos1 ELSE pos1 + ins - 64 END AS pos,
  CASE WHEN unmapped AND k % 14 <> 0 THEN 0 ELSE 29 END AS mapq,
  CASE WHEN unmapped AND k % 14 <> 0 THEN '*' WHEN k % 5 = 1 THEN '4S60M' WHEN k % 5 = 2 THEN '30M2I32M' WHEN k % 5 = 3 THEN '20M3D44M' ELSE '64M' END AS cigar,
  CASE WHEN unmapped THEN NULL WHEN k % 5 = 0 THEN '64' WHEN k % 5 = 1 THEN '60' WHEN k % 5 = 2 THEN '10A51' WHEN k % 5 = 3 THEN '20^ACG44' ELSE '5A3C54' END AS md,
  CASE WHEN NOT paired OR mate_unmapped_raw THEN '*' WHEN n = 1 THEN ref2 ELSE ref1 END AS rnext,
  CASE WHEN NOT paired OR mate_unmapped_raw THEN 0 WHEN n = 1 THEN pos1 + ins - 64 ELSE pos1 END AS pnext,
  CASE WHEN NOT paired OR unmapped OR mate_unmapped_raw OR ref1 <> ref2 THEN 0 WHEN n = 1 THEN ins ELSE -ins END AS tlen,
  seq, qual
FROM c
"""
#: Columns that the odd reads keep from READS.
_KEPT = "unmapped, mate_unmapped, neg, mate_neg, dup, rname, mapq, cigar, rnext, pnext, tlen, seq, qual"
#: Reads without a name, of neither number, repeated at another place or as they stand, secondary and supplementary ones.
ODD_READS = f"""
WITH reads AS ({READS}), o AS (SELECT *, CAST(substr(qname, 2) AS BIGINT) AS k FROM reads)
SELECT CASE WHEN k % 9 = 0 THEN '*' WHEN k % 31 = 0 THEN NULL ELSE qname END AS qname, CASE WHEN paired AND k % 41 = 0 THEN 0 ELSE read_no END AS read_no, paired, not_primary, false AS supplementary, pos, {_KEPT} FROM o
UNION ALL SELECT qname, read_no, paired, false AS not_primary, false AS supplementary, pos + 5000 AS pos, {_KEPT} FROM o WHERE k % 5 = 1 AND NOT unmapped
UNION ALL SELECT qname, read_no, paired, true AS not_primary, false AS supplementary, pos + 77 AS pos, {_KEPT} FROM o WHERE k % 6 = 2
UNION ALL SELECT qname, read_no, paired, false AS not_primary, true AS supplementary, pos + 99 AS pos, {_KEPT} FROM o WHERE k % 6 = 3
UNION ALL SELECT qname, read_no, paired, false AS not_primary, false AS supplementary, pos, {_KEPT} FROM o WHERE k % 7 = 3
"""
RUN_FILES = """
SELECT concat('EAS', CAST(user_id % 4 AS STRING)) AS instrument, concat('FC', CAST(user_id AS STRING)) AS flowcell,
  CASE event_type WHEN 'signup' THEN 'RTAComplete.txt' WHEN 'purchase' THEN 'Basecalling_Netcopy_complete.txt' WHEN 'error' THEN '.rsync_finished' ELSE 'other' END AS file, ts AS mtime
FROM {events}
"""
#: About three files a run, in all states: each marker alone, some or all of the copy markers (once or repeated), versions that
#: are judged by them and others, machines that are started by hand, and none of these.
RUN_MARKERS = """
SELECT concat('EAS', CAST(user_id % 4 AS STRING)) AS instrument, concat(CASE WHEN user_id % 11 = 0 THEN 'SN601_' ELSE '' END, 'FC', CAST(user_id AS STRING), '_', CAST(event_id % 24 AS STRING)) AS flowcell,
  CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN '.rsync_finished' WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'RTAComplete.txt' WHEN event_id % 7 < 2 THEN 'Basecalling_Netcopy_complete.txt'
       WHEN event_id % 7 < 4 THEN 'Basecalling_Netcopy_complete_READ1.txt' WHEN event_id % 7 < 6 THEN 'Basecalling_Netcopy_complete_READ2.txt' ELSE 'other' END AS file,
  ts AS mtime, CASE WHEN user_id % 5 = 0 THEN NULL WHEN user_id % 5 = 1 THEN '1.12.4' ELSE '1.9.35' END AS version
FROM {events}
"""
TARGETS = """
SELECT concat('chr', CAST(1 + p_partkey % 5 AS STRING)) AS chr, 1000 + (p_partkey * 911) % 100000 AS start_pos, 1000 + (p_partkey * 911) % 100000 + 100 + p_size AS end_pos FROM {part}
"""
LANE_SUMMARY = """
SELECT concat('FC', CAST(l_orderkey % 50 AS STRING)) AS flowcell, CAST(1 + l_partkey % 8 AS INT) AS lane, CAST(1 + l_suppkey % 2 AS INT) AS read_no,
  CASE WHEN l_returnflag = 'R' THEN '' ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END AS yield_kb, l_quantity AS clusters_raw, l_quantity * (1 - l_discount) AS clusters_pf FROM {lineitem}
"""
SAMPLE_SHEET = """
SELECT concat('FC', CAST(p_partkey % 50 AS STRING)) AS flowcell, CAST(1 + p_size % 8 AS INT) AS lane,
  translate(substr(md5(CAST(p_partkey % 40 AS STRING)), 1, CASE WHEN p_partkey % 3 = 0 THEN 9 ELSE 6 END), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq,
  concat('ID', lpad(CAST(p_partkey % 40 AS STRING), 2, '0')) AS tag FROM {part}
"""
BARCODES = """
SELECT DISTINCT concat('ID', lpad(CAST(p_partkey % 40 AS STRING), 2, '0')) AS tag,
  translate(substr(md5(CAST(p_partkey % 40 AS STRING)), 1, CASE WHEN p_partkey % 2 = 0 THEN 9 ELSE 6 END), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM {part}
"""
LANE_BARCODES = """
SELECT p_partkey AS id, CASE WHEN p_partkey % 6 = 0 THEN CAST(1 + p_size % 9 AS STRING)
  WHEN p_partkey % 6 = 1 THEN concat(CAST(1 + p_size % 8 AS STRING), '-IDMB', CAST(p_partkey % 700 AS STRING))
  ELSE concat(CAST(1 + p_size % 8 AS STRING), '-ID', lpad(CAST(p_partkey % 40 AS STRING), 2, '0')) END AS lane_barcode FROM {part}
"""
FLOWCELLS = """
SELECT o_orderkey AS id, concat(CAST(110000 + o_custkey % 1231 AS STRING), CASE WHEN o_orderkey % 3 = 0 THEN '_USI-EAS376_' ELSE '_SN166_' END,
  CAST(o_orderkey % 10000 AS STRING), CASE WHEN o_orderkey % 4 = 0 THEN '_FC' ELSE '_B' END, upper(substr(md5(CAST(o_orderkey AS STRING)), 1, 5)), 'ABXX') AS fc,
  concat(CAST(1 + o_orderkey % 8 AS STRING), CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '-ID07' END) AS lane_barcode,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN concat('TREN', CAST(o_custkey AS STRING)) WHEN o_orderkey % 5 = 2 THEN concat('ATLVR', CAST(o_custkey AS STRING)) ELSE o_orderpriority END AS library,
  CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 7 = 1 THEN NULL ELSE concat('chip', CAST(o_orderkey % 3 AS STRING)) END AS chip,
  CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE concat('s', CAST(o_custkey AS STRING)) END AS sample, concat('/ref/', CAST(o_custkey % 9 AS STRING)) AS reference, o_orderdate AS run_date FROM {orders}
"""

#: The base table of each fixture.
BASE = {READS: "orders", ODD_READS: "orders", RUN_FILES: "events", RUN_MARKERS: "events", TARGETS: "part", LANE_SUMMARY: "lineitem", SAMPLE_SHEET: "part", BARCODES: "part", LANE_BARCODES: "part", FLOWCELLS: "orders"}


def load(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    name = BASE[text]
    return spark.sql(text, **{name: spark.read.parquet(f"{sf_dir}/{name}.parquet")})


def ctes(**parts: str) -> str:
    """`WITH name AS (...), ...` over the base views, for the comparing engine."""
    return "WITH " + ",\n".join(f"{name} AS ({text.format(**{BASE[text]: BASE[text]})})" for name, text in parts.items()) + "\n"
