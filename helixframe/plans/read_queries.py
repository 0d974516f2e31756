"""Queries over derived reads, with the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import reads as R
from ..operators import metrics as M
from ..operators import reads as O
from ..operators import suite
from .fixtures import ODD_READS, READS, TARGETS, ctes, load

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return add


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, READS)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads as FASTQ records, a file for each read number, numbered by name."""
    r = reads(spark, sf_dir)
    return r.select(F.concat(F.lit("s_"), F.col("read_no").cast("string")).alias("file"), F.substring("qname", 2, 20).cast("long").alias("rec_no"), F.concat(F.lit("@"), "qname", F.lit("/"), F.col("read_no").cast("string")).alias("header"), "seq", F.lit("+").alias("qual_header"), "qual", "read_no", "paired")


def dictionary(spark: SparkSession) -> DataFrame:
    rows = [(0, "chr1"), (1, "chr2"), (2, O.CONTAMINANT), (3, "chr3"), (4, "chr4"), (5, "chr5")]
    return spark.createDataFrame([(i, n, 200_000, None, None, None) for i, n in rows], "idx int, sn string, ln long, ur string, assembly string, species string")


WITH = ctes(reads=READS)
BASES = "CAST(length(regexp_replace(md, '[^A-Za-z]', '', 'g')) AS BIGINT)"
CIGAR = lambda ops: f"CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[{ops}]', 1), lambda x: CAST(x AS BIGINT))), 0) AS BIGINT)"
END = f"(pos + {CIGAR('MDN=X')} - 1)"
ELIGIBLE = "paired AND NOT unmapped AND NOT mate_unmapped AND read_no <> 1 AND NOT not_primary AND NOT dup AND rname = rnext"
SIZES = f"""s AS (SELECT CASE WHEN neg = mate_neg THEN 'TANDEM' WHEN (CASE WHEN neg THEN pnext ELSE pos END) < (CASE WHEN neg THEN {END} ELSE pos + tlen END) THEN 'FR' ELSE 'RF' END AS orientation,
  CAST(abs(tlen) AS BIGINT) AS size FROM reads WHERE {ELIGIBLE}),
h AS (SELECT orientation, size, count(*) AS pairs FROM s GROUP BY orientation, size),
m AS (SELECT orientation, size AS mode_size, pairs AS mode_pairs FROM h QUALIFY row_number() OVER (PARTITION BY orientation ORDER BY pairs DESC, size) = 1)
"""


@query("alignment_metrics", WITH + f""", p AS (SELECT CASE WHEN NOT paired THEN 'FRAGMENT' ELSE concat('READ', CAST(read_no AS VARCHAR)) END AS read_type, unmapped, dup, seq,
  CASE WHEN NOT unmapped THEN {BASES} + {CIGAR('INHSP')} END AS miss FROM reads),
a AS (SELECT read_type, count(*) AS total_reads, count(*) FILTER (WHERE NOT unmapped) AS mapped_reads, count(*) FILTER (WHERE unmapped) AS unmapped_reads, count(*) FILTER (WHERE NOT unmapped AND dup) AS dup_reads,
  count(*) FILTER (WHERE miss = 0) AS exact_reads, CAST(sum(length(seq)) AS BIGINT) AS total_bases, CAST(sum(length(regexp_replace(seq, '[Nn]', '', 'g'))) AS BIGINT) AS valid_bases,
  CAST(coalesce(sum(miss), 0) AS BIGINT) AS mismatches, CAST(coalesce(sum(length(seq)) FILTER (WHERE NOT unmapped), 0) AS BIGINT) AS mapped_bases FROM p GROUP BY read_type)
SELECT *, 100.0::DOUBLE * mapped_reads / total_reads AS pct_mapped, CASE WHEN mapped_reads = 0 THEN 0 ELSE 100.0::DOUBLE * dup_reads / mapped_reads END AS pct_dup,
  CASE WHEN mapped_reads = 0 THEN 0 ELSE 100.0::DOUBLE * exact_reads / mapped_reads END AS pct_exact, CASE WHEN mapped_bases = 0 THEN 100 ELSE 100.0::DOUBLE * mismatches / mapped_bases END AS pct_mismatch FROM a""")
def alignment_metrics(spark, sf_dir):
    return M.alignment_metrics(reads(spark, sf_dir))


@query("pair_metrics", WITH + """, a AS (SELECT count(*) AS pairs, count(*) FILTER (WHERE unmapped AND mate_unmapped) AS both_unmapped, count(*) FILTER (WHERE NOT unmapped AND NOT mate_unmapped) AS both_mapped,
  count(*) FILTER (WHERE NOT unmapped AND NOT mate_unmapped AND rname = rnext) AS both_mapped_same_chr, count(*) FILTER (WHERE NOT unmapped AND mate_unmapped) AS only_read2_mapped,
  count(*) FILTER (WHERE unmapped AND NOT mate_unmapped) AS only_read1_mapped FROM reads WHERE paired AND read_no <> 1)
SELECT *, 100.0::DOUBLE * both_unmapped / pairs AS pct_both_unmapped, 100.0::DOUBLE * both_mapped / pairs AS pct_both_mapped, 100.0::DOUBLE * both_mapped_same_chr / pairs AS pct_both_mapped_same_chr,
  100.0::DOUBLE * only_read2_mapped / pairs AS pct_only_read2_mapped, 100.0::DOUBLE * only_read1_mapped / pairs AS pct_only_read1_mapped FROM a""")
def pair_metrics(spark, sf_dir):
    return M.pair_metrics(reads(spark, sf_dir))


@query("insert_size_histogram", WITH + "," + SIZES + "SELECT * FROM h")
def insert_size_histogram(spark, sf_dir):
    return M.insert_size_histogram(reads(spark, sf_dir))


@query("insert_size_metrics", WITH + "," + SIZES + """, c AS (SELECT *, sum(pairs) OVER (PARTITION BY orientation ORDER BY size) AS cum, sum(pairs) OVER (PARTITION BY orientation) AS n, sum(pairs) OVER () AS eligible FROM h)
SELECT c.orientation, CAST(max(n) AS BIGINT) AS total_pairs, 100.0::DOUBLE * max(n) / max(eligible) AS pct_pairs, min(size) FILTER (WHERE cum > n // 2) AS median_size, max(mode_size) AS mode_size
FROM c JOIN m ON c.orientation = m.orientation GROUP BY c.orientation HAVING max(n) * 100 > max(eligible) * 10""")
def insert_size_metrics(spark, sf_dir):
    return M.insert_size_metrics(M.insert_size_histogram(reads(spark, sf_dir)))


@query("insert_size_trimmed", WITH + "," + SIZES + """SELECT h.orientation, size, pairs FROM h JOIN (
  SELECT h.orientation AS o, max(size) AS last FROM h JOIN m ON h.orientation = m.orientation WHERE size <= mode_size OR pairs >= floor(CAST(0.25 AS DOUBLE) * mode_pairs) GROUP BY h.orientation) t ON h.orientation = o WHERE size <= last""")
def insert_size_trimmed(spark, sf_dir):
    return M.trim_tail(M.insert_size_histogram(reads(spark, sf_dir)), 0.25)


@query("insert_size_sparse_trim", WITH + "," + SIZES + "SELECT h.orientation, size, pairs FROM h JOIN m ON h.orientation = m.orientation WHERE size <= mode_size OR pairs >= floor(CAST(0.25 AS DOUBLE) * mode_pairs)")
def insert_size_sparse_trim(spark, sf_dir):
    return M.trim_sparse(M.insert_size_histogram(reads(spark, sf_dir)), 0.25)


@query("quality_by_position", WITH + """, b AS (SELECT CASE WHEN paired AND read_no = 2 THEN 2 ELSE 1 END AS series, CAST(unnest(range(1, length(qual) + 1)) AS INT) AS position, CASE WHEN neg THEN reverse(qual) ELSE qual END AS q FROM reads WHERE qual <> '*')
SELECT series, position, CAST(sum(ascii(substr(q, position, 1)) - 33) AS BIGINT) AS quality_sum, count(*) AS n, CAST(sum(ascii(substr(q, position, 1)) - 33) AS DOUBLE) / count(*) AS mean_quality FROM b GROUP BY series, position""")
def quality_by_position(spark, sf_dir):
    return M.quality_by_position(reads(spark, sf_dir))


@query("uniqueness_fragment", WITH + "SELECT count(*) AS total_reads, count(DISTINCT upper(substr(seq, 1, 30))) AS unique_reads, 100.0::DOUBLE * count(DISTINCT upper(substr(seq, 1, 30))) / count(*) AS pct_unique FROM reads WHERE read_no = 1")
def uniqueness_fragment(spark, sf_dir):
    return M.uniqueness_fragment(reads(spark, sf_dir).where("read_no = 1"))


@query("uniqueness_paired", WITH + """, p AS (SELECT concat(upper(substr(a.seq, 1, 30)), upper(substr(b.seq, 1, 30))) AS seed FROM reads a JOIN reads b ON a.qname = b.qname WHERE a.read_no = 1 AND b.read_no = 2)
SELECT count(*) AS total_reads, count(DISTINCT seed) AS unique_reads, 100.0::DOUBLE * count(DISTINCT seed) / count(*) AS pct_unique FROM p""")
def uniqueness_paired(spark, sf_dir):
    rec = records(spark, sf_dir).withColumn("pair_no", F.lit(0))
    return M.uniqueness_paired(O.pair_fastq(rec.where("read_no = 1"), rec.where("read_no = 2")))


@query("adaptor_counts", WITH + "SELECT read_no, count(*) AS total_reads, count(*) FILTER (WHERE instr(seq, 'GATCGGAA') > 0) AS adaptor_reads, 100.0::DOUBLE * count(*) FILTER (WHERE instr(seq, 'GATCGGAA') > 0) / count(*) AS pct_adaptor FROM reads GROUP BY read_no")
def adaptor_counts(spark, sf_dir):
    return M.adaptor_counts(reads(spark, sf_dir))


@query("adaptor_start_histogram", WITH + "SELECT CAST(g AS INT) AS start, count(i) AS reads FROM range(0, 64) t(g) LEFT JOIN (SELECT instr(seq, 'GATCGGAA') - 1 AS i FROM reads) r ON i = g GROUP BY g")
def adaptor_start_histogram(spark, sf_dir):
    return M.adaptor_start_histogram(reads(spark, sf_dir))


BAD = "length(regexp_replace(seq, '[^Nn]', '', 'g')) >= floor(CAST(0.15 AS DOUBLE) * length(seq))"


@query("bad_read_counts", WITH + f"SELECT read_no, count(*) AS total_reads, count(*) FILTER (WHERE {BAD}) AS bad_reads, 100.0::DOUBLE * count(*) FILTER (WHERE {BAD}) / count(*) AS pct_bad FROM reads GROUP BY read_no")
def bad_read_counts(spark, sf_dir):
    return M.bad_read_counts(reads(spark, sf_dir))


@query("n_distribution", WITH + "SELECT read_no, CAST(g AS INT) AS position, count(*) FILTER (WHERE upper(substr(seq, g + 1, 1)) = 'N') AS n_count, 100.0::DOUBLE * count(*) FILTER (WHERE upper(substr(seq, g + 1, 1)) = 'N') / count(*) AS pct_n FROM reads CROSS JOIN (SELECT CAST(r AS INT) AS g FROM range(0, 64) t(r)) GROUP BY read_no, g")
def n_distribution(spark, sf_dir):
    return M.n_distribution(reads(spark, sf_dir))


GONE = "qname IN (SELECT qname FROM reads WHERE NOT unmapped AND lower(rname) = 'gi|9626372|ref|nc_001422.1|')"


@query("contaminant_filter", WITH + f"SELECT qname, read_no, rname, pos FROM reads WHERE NOT {GONE}")
def contaminant_filter(spark, sf_dir):
    return O.filter_contaminant(reads(spark, sf_dir)).select("qname", "read_no", "rname", "pos")


@query("contaminant_reads", WITH + f"SELECT qname, read_no, rname, pos FROM reads WHERE {GONE}")
def contaminant_reads(spark, sf_dir):
    return O.contaminant_reads(reads(spark, sf_dir)).select("qname", "read_no", "rname", "pos")


@query("contaminant_summary", WITH + f"SELECT count(*) AS total_reads, count(*) FILTER (WHERE {GONE}) AS removed_reads, 100.0::DOUBLE * count(*) FILTER (WHERE {GONE}) / count(*) AS pct_removed FROM reads")
def contaminant_summary(spark, sf_dir):
    return O.contaminant_summary(reads(spark, sf_dir))


@query("contaminant_names", WITH + "SELECT DISTINCT qname FROM reads WHERE NOT unmapped AND lower(rname) = 'gi|9626372|ref|nc_001422.1|'")
def contaminant_names(spark, sf_dir):
    return O.contaminant_names(reads(spark, sf_dir))


@query("reindex_reference", WITH + ", d(sn, idx) AS (VALUES ('chr1', 0), ('chr2', 1), ('chr3', 2), ('chr4', 3), ('chr5', 4)) SELECT qname, read_no, coalesce(a.idx, -1) AS ref_idx, coalesce(b.idx, -1) AS mate_ref_idx FROM reads LEFT JOIN d a ON rname = a.sn LEFT JOIN d b ON rnext = b.sn")
def reindex_reference(spark, sf_dir):
    return O.reindex_reference(reads(spark, sf_dir), O.drop_contig(dictionary(spark))).select("qname", "read_no", "ref_idx", "mate_ref_idx")


@query("fix_unmapped", WITH + "SELECT qname, read_no, CASE WHEN unmapped THEN 0 ELSE mapq END AS mapq, CASE WHEN unmapped THEN '*' ELSE cigar END AS cigar FROM reads")
def fix_unmapped(spark, sf_dir):
    return R.fix_unmapped(reads(spark, sf_dir)).select("qname", "read_no", "mapq", "cigar")


@query("fastq_trim", WITH + "SELECT concat('@', qname, '/', CAST(read_no AS VARCHAR)) AS header, concat(substr(seq, 1, 4), substr(seq, 11)) AS seq, concat(substr(qual, 1, 4), substr(qual, 11)) AS qual FROM reads")
def fastq_trim(spark, sf_dir):
    return O.fastq_trim(records(spark, sf_dir), 5, 6).select("header", "seq", "qual")


@query("fastq_search", WITH + "SELECT concat('@', qname, '/', CAST(read_no AS VARCHAR)) AS header, seq FROM reads WHERE qname LIKE 'r12%' ORDER BY read_no, CAST(substr(qname, 2) AS BIGINT) LIMIT 1")
def fastq_search(spark, sf_dir):
    return O.fastq_search(records(spark, sf_dir), "@r12").select("header", "seq")


@query("stop_after", WITH + "SELECT qname, read_no, seq FROM reads ORDER BY qname, read_no LIMIT 101")
def stop_after(spark, sf_dir):
    return O.stop_after(reads(spark, sf_dir), 100, ["qname", "read_no"]).select("qname", "read_no", "seq")


@query("read_types", WITH + "SELECT qname, read_no, CASE WHEN NOT paired THEN 'FRAGMENT' WHEN read_no = 1 THEN 'READ1' ELSE 'READ2' END AS read_type, upper(substr(seq, 1, 30)) AS seed, CAST(instr(seq, 'GATCGGAA') - 1 AS INT) AS adaptor_position FROM reads")
def read_types(spark, sf_dir):
    return reads(spark, sf_dir).select("qname", "read_no", R.read_type().alias("read_type"), R.seed().alias("seed"), R.adaptor_position().cast("int").alias("adaptor_position"))


@query("read_mismatches", WITH + f"SELECT qname, read_no, {BASES} + {CIGAR('INHSP')} AS mismatches, {END} AS alignment_end FROM reads WHERE NOT unmapped")
def read_mismatches(spark, sf_dir):
    return reads(spark, sf_dir).where("NOT unmapped").select("qname", "read_no", R.mismatches().alias("mismatches"), R.alignment_end().alias("alignment_end"))


@query("add_read_group", WITH + "SELECT '0' AS rg, count(*) AS n, 's1' AS sm, 'lib' AS lb, CAST(NULL AS VARCHAR) AS pl, 'pu' AS pu FROM reads")
def add_read_group(spark, sf_dir):
    none = spark.createDataFrame([], "id string, sm string, lb string, pu string, pl string, cn string, dt timestamp")
    got, rg = O.add_read_group(reads(spark, sf_dir), none, sample="s1", library="lib", unit="pu")
    return got.groupBy("rg").agg(F.count(F.lit(1)).alias("n")).join(rg, F.col("rg") == F.col("id")).select("rg", "n", "sm", "lb", "pl", "pu")


@query("fix_read_group", WITH + "SELECT 'g1' AS id, 'new' AS sm, 'old' AS lb, 'p' AS pu, count(*) AS n FROM reads")
def fix_read_group(spark, sf_dir):
    one = spark.createDataFrame([("g1", "s", "old", None, "Illumina", None, None)], "id string, sm string, lb string, pu string, pl string, cn string, dt timestamp")
    got, rg = O.fix_read_group(reads(spark, sf_dir).withColumn("rg", F.lit("g1")), one, sample="new", unit="p")
    return got.groupBy("rg").agg(F.count(F.lit(1)).alias("n")).join(rg, F.col("rg") == F.col("id")).select("id", "sm", "lb", "pu", "n")


@query("fix_sequence_dict", WITH + "SELECT rname AS sn, 'hs37' AS assembly, 'human' AS species, count(*) AS n FROM reads WHERE rname IN ('chr1', 'chr2', 'chr3', 'chr4', 'chr5', 'gi|9626372|ref|NC_001422.1|') GROUP BY rname")
def fix_sequence_dict(spark, sf_dir):
    sq = O.fix_sequence_dict(dictionary(spark), assembly="hs37", species="human")
    return reads(spark, sf_dir).join(F.broadcast(sq), F.col("rname") == F.col("sn")).groupBy("sn", "assembly", "species").agg(F.count(F.lit(1)).alias("n"))  # six contigs


LEAD = "(CASE WHEN regexp_matches(cigar, '^[0-9]+[SH]') THEN CAST(regexp_extract(cigar, '^([0-9]+)', 1) AS BIGINT) ELSE 0 END)"
TAIL = "(CASE WHEN regexp_matches(cigar, '[MDN=XIP][0-9]+[SH]$') THEN CAST(regexp_extract(cigar, '([0-9]+)[SH]$', 1) AS BIGINT) ELSE 0 END)"


@query("mark_duplicates", WITH + f""", e AS (SELECT qname, read_no, rname, neg, CASE WHEN neg THEN {END} + {TAIL} ELSE pos - {LEAD} END AS five,
  CAST(list_sum(list_transform(string_split(qual, ''), lambda c: CASE WHEN ascii(c) - 33 >= 15 THEN ascii(c) - 33 ELSE 0 END)) AS BIGINT) AS score FROM reads WHERE NOT unmapped AND NOT not_primary),
q AS (SELECT qname, string_agg(concat(rname, ':', CAST(five AS VARCHAR), ':', CAST(neg AS VARCHAR)), ';' ORDER BY rname, five, neg) AS ends, sum(score) AS score FROM e GROUP BY qname),
d AS (SELECT qname, row_number() OVER (PARTITION BY ends ORDER BY score DESC, qname) > 1 AS again FROM q)
SELECT r.qname, r.read_no, coalesce(NOT unmapped AND NOT not_primary AND again, false) AS dup FROM reads r LEFT JOIN d ON r.qname = d.qname""")
def mark_duplicates(spark, sf_dir):
    return O.mark_duplicates(reads(spark, sf_dir)).select("qname", "read_no", "dup")


@query("coordinate_sort", WITH + """, d(sn, idx) AS (VALUES ('chr1', 0), ('chr2', 1), ('gi|9626372|ref|NC_001422.1|', 2), ('chr3', 3), ('chr4', 4), ('chr5', 5))
SELECT qname, read_no, row_number() OVER (ORDER BY unmapped, idx NULLS LAST, pos, qname, read_no) AS place, rname, CAST(pos AS BIGINT) AS pos FROM reads LEFT JOIN d ON rname = sn""")
def coordinate_sort(spark, sf_dir):
    return O.coordinate_places(reads(spark, sf_dir), dictionary(spark)).select("qname", "read_no", "place", "rname", F.col("pos").cast("long").alias("pos"))


@query("coordinate_places", WITH + """, d(sn, idx) AS (VALUES ('chr1', 0), ('chr2', 1), ('gi|9626372|ref|NC_001422.1|', 2), ('chr3', 3), ('chr4', 4), ('chr5', 5))
SELECT qname, read_no, row_number() OVER (ORDER BY unmapped, idx NULLS LAST, pos, qname, read_no) AS place FROM reads LEFT JOIN d ON rname = sn""")
def coordinate_places(spark, sf_dir):
    return O.coordinate_places(reads(spark, sf_dir), dictionary(spark)).select("qname", "read_no", "place")


@query("fix_mate_information", WITH + f""", e AS (SELECT *, {END} AS e FROM reads)
SELECT a.qname, a.read_no, coalesce(b.rname, a.rnext) AS rnext, coalesce(b.pos, a.pnext) AS pnext, coalesce(b.neg, a.mate_neg) AS mate_neg, coalesce(b.unmapped, a.mate_unmapped) AS mate_unmapped,
  CASE WHEN b.qname IS NULL THEN a.tlen WHEN a.unmapped OR b.unmapped OR a.rname <> b.rname THEN 0
       WHEN a.pos < b.pos OR (a.pos = b.pos AND a.read_no = 1) THEN greatest(a.e, b.e) - least(a.pos, b.pos) + 1 ELSE -(greatest(a.e, b.e) - least(a.pos, b.pos) + 1) END AS tlen
FROM e a LEFT JOIN e b ON a.qname = b.qname AND a.read_no = 3 - b.read_no AND b.paired AND NOT b.not_primary""")
def fix_mate_information(spark, sf_dir):
    return O.fix_mate_information(reads(spark, sf_dir)).select("qname", "read_no", "rnext", "pnext", "mate_neg", "mate_unmapped", "tlen")


@query("fix_mate_information_odd", ctes(reads=ODD_READS) + f""", e AS (SELECT *, {END} AS e, coalesce(paired AND qname <> '*' AND read_no IN (1, 2), false) AS named, NOT not_primary AND NOT supplementary AS prim FROM reads),
n AS (SELECT *, CASE WHEN named AND prim THEN row_number() OVER (PARTITION BY qname, read_no, named, prim ORDER BY rname, pos, neg, cigar, mapq, unmapped, seq, qual) ELSE 1 END AS nth FROM e),
b AS (SELECT * FROM n WHERE named AND prim)
SELECT a.qname, a.read_no, a.rname, CAST(a.pos AS BIGINT) AS pos, a.not_primary, a.supplementary, CASE WHEN b.qname IS NULL THEN a.rnext ELSE b.rname END AS rnext, CASE WHEN b.qname IS NULL THEN a.pnext ELSE b.pos END AS pnext,
  CASE WHEN b.qname IS NULL THEN a.mate_neg ELSE b.neg END AS mate_neg, CASE WHEN b.qname IS NULL THEN a.mate_unmapped ELSE b.unmapped END AS mate_unmapped,
  CASE WHEN b.qname IS NULL THEN a.tlen WHEN a.unmapped OR b.unmapped OR a.rname <> b.rname THEN 0
       WHEN a.pos < b.pos OR (a.pos = b.pos AND a.read_no = 1) THEN greatest(a.e, b.e) - least(a.pos, b.pos) + 1 ELSE -(greatest(a.e, b.e) - least(a.pos, b.pos) + 1) END AS tlen
FROM n a LEFT JOIN b ON a.named AND a.qname = b.qname AND a.read_no = 3 - b.read_no AND a.nth = b.nth""")
def fix_mate_information_odd(spark, sf_dir):
    return O.fix_mate_information(load(spark, sf_dir, ODD_READS)).select("qname", "read_no", "rname", F.col("pos").cast("long").alias("pos"), "not_primary", "supplementary", "rnext", "pnext", "mate_neg", "mate_unmapped", "tlen")


@query("mark_duplicates_odd", ctes(reads=ODD_READS) + f""", e AS (SELECT qname, {{'rname': rname, 'five': CASE WHEN neg THEN {END} + {TAIL} ELSE pos - {LEAD} END, 'neg': neg}} AS at_,
  CAST(list_sum(list_transform(string_split(qual, ''), lambda c: CASE WHEN ascii(c) - 33 >= 15 THEN ascii(c) - 33 ELSE 0 END)) AS BIGINT) AS score FROM reads WHERE NOT unmapped AND NOT not_primary AND NOT supplementary AND qname <> '*'),
q AS (SELECT qname, min(at_) AS low, max(at_) AS high, count(*) AS n, sum(score) AS score FROM e GROUP BY qname),
d AS (SELECT qname, row_number() OVER (PARTITION BY low, high, n ORDER BY score DESC, qname) > 1 AS again FROM q)
SELECT r.qname, r.read_no, r.rname, CAST(r.pos AS BIGINT) AS pos, not_primary, supplementary, coalesce(NOT unmapped AND NOT not_primary AND NOT supplementary AND again, false) AS dup FROM reads r LEFT JOIN d ON r.qname = d.qname""")
def mark_duplicates_odd(spark, sf_dir):
    return O.mark_duplicates(load(spark, sf_dir, ODD_READS)).select("qname", "read_no", "rname", F.col("pos").cast("long").alias("pos"), "not_primary", "supplementary", "dup")


CAPTURE = ctes(reads=READS, raw_targets=TARGETS) + f""", targets AS (SELECT DISTINCT * FROM raw_targets), al AS (SELECT qname, read_no, rname AS chr, pos AS s, {END} AS e FROM reads WHERE NOT unmapped),
o AS (SELECT qname, read_no, s AS r_start, e AS r_end, t.chr AS chr, start_pos, end_pos, s <= end_pos AND e >= start_pos AS on_target FROM al JOIN targets t ON al.chr = t.chr AND s <= end_pos + 100 AND e >= start_pos - 100)
"""


@query("capture_overlap", CAPTURE + "SELECT * FROM o")
def capture_overlap(spark, sf_dir):
    return M.capture_overlap(reads(spark, sf_dir), load(spark, sf_dir, TARGETS))


@query("target_depth", CAPTURE + """, ev AS (SELECT chr, s AS loc, 1 AS r, 0 AS t FROM al UNION ALL SELECT chr, e + 1, -1, 0 FROM al UNION ALL SELECT chr, start_pos, 0, 1 FROM targets UNION ALL SELECT chr, end_pos + 1, 0, -1 FROM targets),
st AS (SELECT chr, loc, sum(r) AS r, sum(t) AS t FROM ev GROUP BY chr, loc),
ru AS (SELECT chr, sum(r) OVER w AS depth, sum(t) OVER w AS tt, lead(loc) OVER (PARTITION BY chr ORDER BY loc) - loc AS n FROM st WINDOW w AS (PARTITION BY chr ORDER BY loc))
SELECT chr, CAST(depth AS BIGINT) AS depth, CAST(sum(n) AS BIGINT) AS bases FROM ru WHERE tt > 0 AND n IS NOT NULL GROUP BY chr, depth""")
def target_depth(spark, sf_dir):
    return M.target_depth(reads(spark, sf_dir), load(spark, sf_dir, TARGETS))


@query("capture_metrics", CAPTURE + """, ev AS (SELECT chr, s AS loc, 1 AS r, 0 AS t FROM al UNION ALL SELECT chr, e + 1, -1, 0 FROM al UNION ALL SELECT chr, start_pos, 0, 1 FROM targets UNION ALL SELECT chr, end_pos + 1, 0, -1 FROM targets),
st AS (SELECT chr, loc, sum(r) AS r, sum(t) AS t FROM ev GROUP BY chr, loc),
ru AS (SELECT sum(r) OVER w AS depth, sum(t) OVER w AS tt, lead(loc) OVER (PARTITION BY chr ORDER BY loc) - loc AS n FROM st WINDOW w AS (PARTITION BY chr ORDER BY loc)),
dp AS (SELECT depth, sum(n) AS bases FROM ru WHERE tt > 0 AND n IS NOT NULL GROUP BY depth)
SELECT (SELECT count(*) FROM reads) AS total_reads, (SELECT count(*) FROM reads WHERE NOT unmapped) AS aligned_reads, (SELECT count(*) FROM reads WHERE NOT unmapped AND dup) AS duplicate_reads,
  (SELECT count(*) FROM (SELECT DISTINCT qname, read_no FROM o WHERE on_target)) AS target_reads, (SELECT count(*) FROM (SELECT DISTINCT qname, read_no FROM o)) AS target_or_buffer_reads,
  (SELECT count(*) FROM (SELECT DISTINCT qname, read_no FROM o)) - (SELECT count(*) FROM (SELECT DISTINCT qname, read_no FROM o WHERE on_target)) AS buffer_reads,
  (SELECT count(*) FROM (SELECT DISTINCT chr, start_pos, end_pos FROM o WHERE on_target)) AS targets_hit, (SELECT count(*) FROM (SELECT DISTINCT chr, start_pos, end_pos FROM o)) AS target_buffers_hit, (SELECT count(*) FROM targets) AS total_targets,
  CAST(sum(bases) AS BIGINT) AS target_bases, CAST(sum(bases * depth) AS DOUBLE) / sum(bases) AS mean_coverage,
  CAST(coalesce(sum(bases) FILTER (WHERE depth >= 1), 0) AS BIGINT) AS bases_1x, CAST(coalesce(sum(bases) FILTER (WHERE depth >= 4), 0) AS BIGINT) AS bases_4x, CAST(coalesce(sum(bases) FILTER (WHERE depth >= 10), 0) AS BIGINT) AS bases_10x,
  CAST(coalesce(sum(bases) FILTER (WHERE depth >= 20), 0) AS BIGINT) AS bases_20x, CAST(coalesce(sum(bases) FILTER (WHERE depth >= 40), 0) AS BIGINT) AS bases_40x FROM dp""")
def capture_metrics(spark, sf_dir):
    return M.capture_metrics(reads(spark, sf_dir), load(spark, sf_dir, TARGETS))


def long_form(calculator: str, keys: list[str], values: list[str]) -> str:
    """SQL of a calculator's rows as (calculator, metric, value): metric is its keys and the column's name."""
    key = "".join(f"CAST({k} AS VARCHAR), '/', " for k in keys)
    return " UNION ALL ".join(f"SELECT '{calculator}' AS calculator, concat({key}'{v}') AS metric, CAST({v} AS DOUBLE) AS value FROM {calculator}_rows" for v in values)


SUITE = {
    "alignment": ("alignment_metrics", ["read_type"], ["total_reads", "mapped_reads", "unmapped_reads", "dup_reads", "exact_reads", "total_bases", "valid_bases", "mismatches", "mapped_bases", "pct_mapped", "pct_dup", "pct_exact", "pct_mismatch"]),
    "pairs": ("pair_metrics", [], ["pairs", *[p + c for p in ("", "pct_") for c in ("both_unmapped", "both_mapped", "both_mapped_same_chr", "only_read2_mapped", "only_read1_mapped")]]),
    "insert_size": ("insert_size_metrics", ["orientation"], ["total_pairs", "pct_pairs", "median_size", "mode_size"]),
    "insert_size_histogram": ("insert_size_histogram", ["orientation", "size"], ["pairs"]),
    "quality": ("quality_by_position", ["series", "position"], ["quality_sum", "n", "mean_quality"]),
    "n_content": ("n_distribution", ["read_no", "position"], ["n_count", "pct_n"]),
}


@query("metric_suite", "WITH " + ", ".join(f"{name}_rows AS ({SQL[of]})" for name, (of, _, _) in SUITE.items()) + " " + " UNION ALL ".join(long_form(name, keys, values) for name, (_, keys, values) in SUITE.items()))
def metric_suite(spark, sf_dir):
    return suite.metric_suite(reads(spark, sf_dir))
