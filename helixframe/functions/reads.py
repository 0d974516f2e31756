"""Columns of reads: type, mismatches, orientation, seed, adaptor and N content."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED_BASES = 30
#: Fixed values of the adaptor search and the bad-read rule.
ADAPTOR = "GATCGGAA"
BAD_SHARE = 0.15


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def read_type(paired="paired", read_no="read_no") -> Column:
    """FRAGMENT, READ1 or READ2; null for a paired read that is neither first nor second."""
    return F.when(~col(paired), "FRAGMENT").when(col(read_no).isin(1, 2), F.concat(F.lit("READ"), col(read_no).cast("string")))


def primary(reads: DataFrame) -> Column:
    """Neither secondary nor, if `reads` has that column, supplementary."""
    return ~F.col("not_primary") & (~F.col("supplementary") if "supplementary" in reads.columns else F.lit(True))


def _count_of(text: Column, letters: str) -> Column:
    """How many characters of `text` are in `letters`; no regular expression is needed to count them."""
    return F.length(text) - F.length(F.translate(text, letters, ""))


def cigar_length(cigar, ops: str) -> Column:
    """Total length of the CIGAR elements whose operation is in `ops`; 0 for `*`, null or none."""
    found = F.regexp_extract_all(col(cigar), F.lit(f"(\\d+)[{ops}]"), F.lit(1))
    return F.coalesce(F.aggregate(found, F.lit(0).cast("long"), lambda a, x: a + x.cast("long")), F.lit(0).cast("long"))


def mismatches(md="md", cigar="cigar", missing_md: str = "error") -> Column:
    """Letters in MD plus the lengths of inserted, skipped, clipped and padded elements.

    A mapped read must have MD: without it the query fails, or counts no letters with missing_md="zero". Call it on mapped reads.
    """
    letters = _count_of(col(md), string.ascii_letters).cast("long")
    none = F.raise_error(F.lit("a mapped read has no MD tag")).cast("long") if missing_md == "error" else F.lit(0).cast("long")
    return F.coalesce(letters, none) + cigar_length(cigar, "INHSP")


def alignment_end(pos="pos", cigar="cigar") -> Column:
    return col(pos) + cigar_length(cigar, "MDN=X") - 1


def pair_orientation(pos="pos", pnext="pnext", tlen="tlen", neg="neg", mate_neg="mate_neg", cigar="cigar") -> Column:
    """TANDEM on one strand; FR if the positive strand's 5' end comes before the negative one's, else RF."""
    plus = F.when(col(neg), col(pnext)).otherwise(col(pos))
    minus = F.when(col(neg), alignment_end(pos, cigar)).otherwise(col(pos) + col(tlen))
    return F.when(col(neg) == col(mate_neg), "TANDEM").when(plus < minus, "FR").otherwise("RF")


def insert_size_eligible() -> Column:
    """Second reads, primary and not duplicate, of pairs mapped to one reference."""
    return col("paired") & ~col("unmapped") & ~col("mate_unmapped") & (col("read_no") != 1) & ~col("not_primary") & ~col("dup") & same_chr_pair()


def same_chr_pair(rname="rname", rnext="rnext") -> Column:
    return col(rname) == F.when(col(rnext) == "=", col(rname)).otherwise(col(rnext))


def seed(seq="seq", bases: int = SEED_BASES, strict: bool = False) -> Column:
    """The first bases in upper case; a shorter read keeps what it has, or fails if `strict`."""
    cut = F.upper(F.substring(col(seq), 1, bases))
    return F.when(F.length(col(seq)) < bases, F.raise_error(F.lit(f"a read is shorter than {bases} bases")).cast("string")).otherwise(cut) if strict else cut


def adaptor_position(seq="seq", adaptor: str = ADAPTOR) -> Column:
    """0-based place of the first match, or -1."""
    return F.instr(col(seq), adaptor) - 1


def n_count(seq="seq") -> Column:
    return _count_of(col(seq), "Nn")


def is_bad_read(seq="seq", share: float = BAD_SHARE) -> Column:
    return n_count(seq) >= F.floor(F.lit(share) * F.length(col(seq)))


def fix_unmapped(df):
    """Unmapped reads get mapping quality 0 and no CIGAR."""
    return df.withColumns({"mapq": F.when(col("unmapped"), F.lit(0)).otherwise(col("mapq")), "cigar": F.when(col("unmapped"), F.lit("*")).otherwise(col("cigar"))})


def trimmed(text, start: int, n: int) -> Column:
    """Without its n characters from the 1-based start on."""
    return F.concat(F.substring(col(text), 1, start - 1), F.substr(col(text), F.lit(start + n)))


def unclipped_start(pos="pos", cigar="cigar") -> Column:
    return col(pos) - F.coalesce(F.regexp_extract(col(cigar), r"^(?:\d+H)?(\d+)S", 1).try_cast("long"), F.lit(0)) - F.coalesce(F.regexp_extract(col(cigar), r"^(\d+)H", 1).try_cast("long"), F.lit(0))


def unclipped_end(pos="pos", cigar="cigar") -> Column:
    tail = F.regexp_extract(col(cigar), r"[MDN=XIP]((?:\d+[SH])+)$", 1)
    return alignment_end(pos, cigar) + cigar_length(tail, "SH")


def soft_clipped(cigar: Column, kept: Column) -> Column:
    """The CIGAR with only the first `kept` bases of the read aligned or inserted as they were and the others soft-clipped; a hard clip at the end stays."""
    part = F.regexp_extract_all(cigar, F.lit(r"\d+[MIDNSHP=X]"), F.lit(0))
    state = F.struct(F.lit(0).cast("long").alias("used"), F.lit("").alias("out"))

    def add(s: Column, e: Column) -> Column:
        n, op = F.regexp_extract(e, r"(\d+)", 1).cast("long"), F.substring(e, -1, 1)
        of_read, room = op.isin(*"MIS=X"), F.greatest(kept - s["used"], F.lit(0))
        piece = F.when(of_read & (room > 0), F.concat(F.least(n, room).cast("string"), op)).when(~of_read & (room > 0), e).otherwise("")
        return F.struct((s["used"] + F.when(of_read, n).otherwise(0)).alias("used"), F.concat(s["out"], piece).alias("out"))

    end = F.aggregate(part, state, add)
    front = F.regexp_extract(end["out"], r"^(\d+H)?", 1)
    bare = F.regexp_replace(end["out"], r"^(\d+H)?(\d+S)?", "") == ""
    tail = F.regexp_extract(cigar, r"[^H](\d+H)$", 1)
    rest = end["used"] - F.greatest(kept, F.lit(0))
    return F.when(rest <= 0, cigar).when(bare, F.concat(front, end["used"].cast("string"), F.lit("S"), tail)).otherwise(F.concat(F.regexp_replace(end["out"], r"(?<=\D)\d+S$", ""), F.lit(""), rest.cast("string"), F.lit("S"), tail))


def _quality_sums(qual: pa.Array, least: int) -> pa.Array:
    """Sums over the bytes of all strings at once; 0 for null."""
    if not len(qual):
        return pa.array([], pa.int64())
    text = qual.cast(pa.large_binary())
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].astype(np.int64) - 33
    total = np.concatenate([[0], np.cumsum(np.where(data >= least, data, 0))])
    return pa.array(total[ends[1:] - ends[0]] - total[ends[:-1] - ends[0]])


#: The columns of letters_by_position().
LETTERS_BY_POSITION = "read_no int, position long, letter string, n long"


def letters_by_position(reads: pa.Table) -> pa.Table:
    """How often each byte of `seq` is at each position (from 1) of reads with each `read_no`; reads without a number have 0, those without text count nothing."""
    reads = reads.filter(pc.is_valid(reads["seq"]))
    text = pa.chunked_array(reads["seq"].chunks, pa.string()).cast(pa.large_binary()).combine_chunks()
    text = text if isinstance(text, pa.Array) else pa.concat_arrays(text.chunks or [pa.array([], pa.large_binary())])
    if not len(text):
        return pa.table({"read_no": pa.array([], pa.int32()), "position": pa.array([], pa.int64()), "letter": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    letters = np.frombuffer(text.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    sizes = np.diff(ends)
    places = np.arange(len(letters)) - np.repeat(ends[:-1] - ends[0], sizes)
    numbers = np.repeat(pc.fill_null(reads["read_no"], 0).to_numpy().astype(np.int64), sizes)
    width = int(sizes.max(initial=0)) + 1
    keys, n = np.unique((numbers * width + places) * 256 + letters, return_counts=True)
    names = [chr(k) for k in range(256)]
    return pa.table({"read_no": pa.array(keys // 256 // width, pa.int32()), "position": pa.array(keys // 256 % width + 1, pa.int64()), "letter": pa.array([names[k] for k in keys % 256], pa.string()), "n": pa.array(n, pa.int64())})


def quality_sum(qual="qual", least: int = 15) -> Column:
    """Sum of the base qualities of at least `least`; no built-in function folds characters outside of interpreted code, so Arrow batches go to numpy."""

    @F.arrow_udf("long")
    def sums(text: pa.Array) -> pa.Array:
        return _quality_sums(text, least)

    return sums(col(qual))


def format_half_even(x) -> Column:
    return F.call_function("format_number", col(x), F.lit("#0.00"))


def format_half_up(x) -> Column:
    return F.format_string("%.2f", col(x).cast("double"))
