"""Columns of names: lane barcodes, flowcells, platform units, read groups, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .reads import col

#: The rules by library name (pattern, reference, chip design).
LIBRARY_RULES = [("TREN", "hg19/original/hg19.fa", "ezexome2_hg19"), ("TLVR", "hg19/original/hg19.fa", "vcrome2.1_hg19")]
#: The folder in a run's folder.
DATA_FOLDER = "data_dir"
#: What begins a machine's name and a flowcell's.
MACHINE, FLOWCELL = "USI-", "FC"
DIGITS = "0123456789"


def lane_barcode_valid(name, multiplexed: bool = True) -> Column:
    return col(name).rlike(r"^[1-8](-ID(\d\d|MB\d\d?))?$" if multiplexed else "^[1-8]$")


def is_multiplexed_name(name) -> Column:
    return col(name).rlike(r"[1-8]-ID(\d\d|MB)")


def split_lane_barcode(name) -> tuple[Column, Column]:
    """Lane (first character) and tag (what follows the digit and hyphen; empty without one)."""
    return F.substring(col(name), 1, 1), F.when(col(name).contains("-"), F.regexp_replace(col(name), r"^\d-", "")).otherwise(F.lit(""))


def is_hiseq(fc) -> Column:
    return ~col(fc).rlike("EAS034|EAS376")


def lims_flowcell(fc) -> Column:
    """Trailing letters and digits, without a leading FC and then without one leading letter."""
    tail = F.regexp_extract(col(fc), "([a-zA-Z0-9]+)$", 1)
    return F.regexp_replace(F.regexp_replace(tail, "^FC", ""), "^[a-zA-Z]", "")


def platform_unit(fc, lane_barcode) -> Column:
    machine = F.regexp_replace(F.regexp_extract(F.regexp_replace(col(fc), r"^\d+_", ""), "([A-Za-z0-9-]+)", 1), "SN", "700")
    return F.concat(machine, F.lit("_20"), F.regexp_extract(col(fc), r"^(\d+)", 1), F.lit("_"), lims_flowcell(fc), F.lit("-"), col(lane_barcode))


def _by_library(library, k: int, other: Column) -> Column:
    out = other
    for rule in reversed(LIBRARY_RULES):
        out = F.when(col(library).contains(rule[0]), F.lit(rule[k])).otherwise(out)
    return out


def reference_override(library, reference) -> Column:
    return _by_library(library, 1, col(reference))


def chip_override(library, chip) -> Column:
    """Only where a chip design is set; an empty one counts as none."""
    return F.when(F.length(col(chip)) > 0, _by_library(library, 2, col(chip)))


def read_group_string(sample, library, unit, fc_barcode, date, center: str) -> Column:
    given = lambda c: F.nullif(col(c), F.lit(""))
    field = lambda tag, value: F.concat(F.lit(f"{tag}:"), value)
    return F.concat_ws(
        "\t", F.lit("@RG"), F.lit("ID:0"), field("SM", F.coalesce(given(sample), col(fc_barcode))), field("LB", given(library)),
        field("PU", F.coalesce(given(unit), col(fc_barcode))), F.lit(f"CN:{center}"), field("DT", F.date_format(col(date), "yyyy-MM-dd'T'HH:mm:ssXXX")), F.lit("PL:Illumina"),
    )


def split_mean_sd(name, value) -> tuple[Column, Column, Column]:
    """Mean, name of the deviation and deviation of `a +/- b`; the last two are null for a plain value."""
    two = col(value).contains("+/-")
    return (
        F.when(two, F.trim(F.regexp_extract(col(value), r"^(.*?)\s*\+/-", 1))).otherwise(col(value)),
        F.when(two, F.concat(F.lit("+/- SD "), col(name))),
        F.when(two, F.trim(F.regexp_extract(col(value), r"\+/-\s*(.*)$", 1))),
    )


def _made_of(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "") == ""


def _number(text: Column) -> Column:
    return (F.length(text) > 0) & _made_of(text, DIGITS)


def _first(items: Column, test) -> Column:
    """The 0-based place of the first item that passes, or null."""
    return F.get(F.filter(F.transform(items, lambda x, k: F.when(test(x, k), k)), lambda k: k.isNotNull()), F.lit(0))


def _let(value: Column, then) -> Column:
    """`then` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _rest(items: Column, k) -> Column:
    """The items from the 0-based place k on."""
    return F.slice(items, k + 1, F.greatest(F.size(items) - k, F.lit(0)))


def _kind(fields: Column) -> Column:
    """A run's type among the fields before its flowcell: the last one if it is made of P, E, 1 and 2; a blank one is Fragment."""
    last = F.coalesce(F.get(fields, F.size(fields) - 1), F.lit(""))
    return F.when((last != "") & _made_of(last, "PE12"), last).otherwise("Fragment")


def _run(name: Column, kind: Column, sample: Column, date=None, machine=None, flowcell=None) -> Column:
    given = lambda c: F.lit(None).cast("string") if c is None else c
    return F.struct(name.alias("run"), given(date).alias("date_created"), given(machine).alias("instrument"), kind.alias("type"), given(flowcell).alias("fc"), sample.alias("sample"))


def _timed_run(name: Column) -> Column:
    """A day, a time of day, and a number with or without the type, then the sample; null for other names."""

    def of(fields: Column) -> Column:
        clock = F.split(F.get(fields, F.lit(1)), "-")
        day = F.get(fields, F.lit(0))
        fits = (day != "") & _made_of(day, DIGITS + "-") & (F.size(clock) == 3) & F.forall(clock, lambda x: (F.length(x) == 2) & _number(x))
        return F.when(fits, _let(F.array_join(_rest(fields, F.lit(2)), "_"), sampled))

    def sampled(text: Column) -> Column:
        head = F.split(F.substring_index(text, "-", 1), "_")
        fits = text.contains("-") & _number(F.get(head, F.lit(0))) & ((F.size(head) == 1) | ((F.size(head) == 2) & _made_of(F.get(head, F.lit(1)), "PE12")))
        return F.when(fits, _run(name, _kind(_rest(head, F.lit(1))), F.substr(text, F.length(F.substring_index(text, "-", 1)) + 2)))

    return _let(F.split(name, "_"), of)


def _flowcell_run(name: Column) -> Column:
    """Fields up to a flowcell, then a lane and the sample; null for other names."""

    def of_pieces(pieces: Column) -> Column:
        cell = lambda k: F.element_at(F.split(F.get(pieces, k), "_"), -1)
        is_lane = lambda x, k: (k > 0) & (k < F.size(pieces) - 1) & x.startswith("L") & _number(F.substring(x, 2, 99)) & cell(k - 1).startswith(FLOWCELL) & (F.length(cell(k - 1)) > 2)
        return _let(_first(pieces, is_lane), lambda lane: F.when(lane.isNotNull(), _let(F.split(F.array_join(F.slice(pieces, 1, lane), "-"), "_"), lambda before: of_fields(before, F.array_join(_rest(pieces, lane + 1), "-")))))

    def of_fields(before: Column, sample: Column) -> Column:
        plain = _run(name, _kind(F.slice(before, 1, F.size(before) - 1)), sample)
        machine = _first(before, lambda x, k: x.startswith(MACHINE) & (k > 0))
        return _let(machine, lambda at: F.when(at.isNull(), plain).otherwise(F.coalesce(with_machine(before, at, sample), plain)))

    def with_machine(before: Column, at: Column, sample: Column) -> Column:
        between = F.slice(before, at + 2, F.greatest(F.size(before) - at - 2, F.lit(0)))
        first = lambda x: F.coalesce(F.get(x, F.lit(0)), F.lit(""))
        no_number = lambda x: F.when(_number(first(x)), _rest(x, F.lit(1))).otherwise(x)
        no_read = lambda x: F.when((first(x) != "") & _made_of(first(x), "R2"), _rest(x, F.lit(1))).otherwise(x)
        date = F.element_at(F.split(F.get(before, at - 1), "-"), -1)
        number = F.when(date.startswith("CF"), F.substring(date, 3, 99)).otherwise(date)
        run = lambda kind, day: F.when(_number(day) & (F.size(kind) < 2) & _made_of(first(kind), "PE12"), _run(name, _kind(kind), sample, day, F.get(before, at), F.element_at(before, -1)))
        return _let(between, lambda x: _let(no_number(x), lambda y: _let(no_read(y), lambda kind: _let(number, lambda day: run(kind, day)))))

    return _let(F.split(name, "-"), of_pieces)


def parse_run_path(path) -> Column:
    """struct(run, date_created, instrument, type, fc, sample) of the run folder before DATA_FOLDER; null if its name is none of a run.

    A name is fields between underscores. With a flowcell, hyphens part it from a lane (L and digits) and the sample; a machine
    before it has the date in front of it (behind a hyphen and CF, if it has those) and a number, a read and the type
    behind it, each of which may be missing. Date, machine and flowcell are given for names with a machine only. Without a
    flowcell, a name is a day, a time of day of three numbers, and a number, perhaps with the type, then the sample.
    """
    name = lambda folders: F.get(folders, F.array_position(folders, F.lit(DATA_FOLDER)).cast("int") - 2)
    return _let(F.split(col(path), "/"), lambda folders: _let(name(folders), lambda n: F.coalesce(_flowcell_run(n), _timed_run(n))))


def rta_version(run_parameters, netcopy) -> Column:
    """From the run parameters' XML if there is any, else from the copy marker's text."""
    marker = F.nullif(F.regexp_extract(col(netcopy), r"Illumina\s+RTA\s+([^\r\n]*)", 1), F.lit(""))
    return F.when(col(run_parameters).isNotNull(), F.nullif(F.xpath_string(col(run_parameters), F.lit("RunParameters/Setup/RTAVersion")), F.lit(""))).otherwise(marker)


def hamming_distance(a, b) -> Column:
    """Length difference plus mismatches over the common prefix."""
    both = F.least(F.length(col(a)), F.length(col(b)))
    pairs = F.zip_with(F.split(F.substr(col(a), F.lit(1), both), ""), F.split(F.substr(col(b), F.lit(1), both), ""), lambda x, y: (x != y).cast("int"))
    return F.abs(F.length(col(a)) - F.length(col(b))) + F.aggregate(pairs, F.lit(0), lambda s, x: s + x)
