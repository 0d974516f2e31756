"""Packed token-id matrices.

Texts are tokenised in Arrow batches with a public byte-level BPE (its ranks are read on the driver and broadcast). A task
packs its rows in groups of about GROUP_TOKENS tokens: documents longer than a row are split, losing nothing, and pieces
are placed longest first, each into the fullest row that still holds it. That row is found in a segment tree over free
capacities, in the logarithm of the row length. No data is shuffled, a task's memory does not grow with its input, and a
lost task makes the same rows again.

The query writes the rows as Parquet to the shared folder (compressed by zstd, under which the positions take next to nothing)
and returns what it reads back.

A packed row is a fixed-length array of little-endian ids (16 bits if the vocabulary fits, else 32), the segments' cumulative
lengths, a position array (16 bits if the row is no longer than that) that starts again at 0 with each segment, and for each segment its document and offset in it.

Defined cases: null and empty texts are one end token. Runs of any length, of white space or of letters, are tokenised whole. Repeated rows are packed each. Empty input gives no row. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import new_folder, table

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pre-token pattern of these ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROW = 2048
GROUP_TOKENS = 2_000_000


#: White space of the pattern, and the length from which a run of it is cut out before: the pattern's engine fails on very long ones.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 10_000
_RUN = re.compile(f"[{SPACES}]{{{LONG_RUN},}}")


def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def token_ids(coder, text: str) -> np.ndarray:
    """The ids of the whole text.

    A run of white space is one pre-token up to its last character, which goes with what follows, or up to the end of the text.
    So a long run is merged by itself, and the pattern sees only what is between such runs.
    """
    parts, at = [], 0
    for run in _RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        parts.append(coder.encode_to_numpy(text[at : run.start()], disallowed_special=()))
        parts.append(np.array(coder._encode_single_piece(text[run.start() : end].encode()), np.uint32))
        at = end
    parts.append(coder.encode_to_numpy(text[at:], disallowed_special=()))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


class Capacities:
    """Open rows by free capacity; best(need) is the least capacity of any row that holds `need`."""

    def __init__(self, most: int):
        self.leaves = 1 << (most + 1).bit_length()
        self.n = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, row: int, free: int) -> None:
        self.rows[free].append(row)
        self._add(free, 1)

    def _add(self, free: int, by: int) -> None:
        at = free + self.leaves
        while at:
            self.n[at] += by
            at >>= 1

    def best(self, need: int) -> int | None:
        at = need + self.leaves
        while not self.n[at]:
            while at & 1:  # a right child: nothing to the right under this parent
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.n[2 * at] else 2 * at + 1
        return at - self.leaves

    def take(self, free: int) -> int:
        self._add(free, -1)
        return self.rows[free].pop()


def best_fit(lengths: list[int], row: int) -> list[list[int]]:
    """Indices of the pieces in each row; pieces longest first, ties in order."""
    open_, rows = Capacities(row), []
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        need = lengths[i]
        free = open_.best(need)
        at = open_.take(free) if free is not None else len(rows)
        if free is None:
            rows.append([])
            free = row
        rows[at].append(i)
        if free > need:
            open_.put(at, free - need)
    return rows


def token_matrix(docs: DataFrame, ranks: dict[bytes, int], row: int = ROW, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """(pack_id, n_tokens, doc_ids, offsets, cu_seqlens, input_ids, position_ids): packed rows of all documents; see the module's text."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    end = len(ranks)
    kind = np.dtype("<u2" if end < 65_536 else "<u4")
    place = np.dtype("<u2" if row <= 65_536 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
        base, made = TaskContext.get().partitionId() << 33, 0
        pieces: list[tuple[object, int, np.ndarray]] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            columns: list[list] = [[] for _ in range(7)]
            for members in best_fit([len(p[2]) for p in pieces], row):
                mine = [pieces[i] for i in members]
                ends = np.cumsum([len(p[2]) for p in mine])
                ids, places = np.full(row, end, kind), np.zeros(row, place)
                ids[: ends[-1]] = np.concatenate([p[2] for p in mine])
                places[: ends[-1]] = np.concatenate([np.arange(len(p[2])) for p in mine])
                for column, value in zip(columns, (base + made, int(ends[-1]), [p[0] for p in mine], [p[1] for p in mine], [0, *ends.tolist()], ids.tobytes(), places.tobytes()), strict=True):
                    column.append(value)
                made += 1
                if len(columns[0]) == 500:
                    yield _rows(columns, id_kind)
                    columns = [[] for _ in range(7)]
            if columns[0]:
                yield _rows(columns, id_kind)

        id_kind = pa.int64()
        for batch in batches:
            id_kind = batch.schema.field(1).type
            for text, doc in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                ids = np.append(token_ids(coder, text.as_py() or ""), end).astype(kind)
                for at in range(0, len(ids), row):
                    pieces.append((doc, at, ids[at : at + row]))
                held += len(ids)
                if held >= group_tokens:
                    yield from flush()
                    pieces, held = [], 0
        if pieces:
            yield from flush()

    fields = (("pack_id", T.LongType()), ("n_tokens", T.IntegerType()), ("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)), ("offsets", T.ArrayType(T.LongType())), ("cu_seqlens", T.ArrayType(T.IntegerType())), ("input_ids", T.BinaryType()), ("position_ids", T.BinaryType()))
    return docs.select(F.col("text").cast("string"), "doc_id").mapInArrow(run, T.StructType([T.StructField(n, t) for n, t in fields]))


def _rows(columns: list[list], id_kind: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.list_(id_kind), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["pack_id", "n_tokens", "doc_ids", "offsets", "cu_seqlens", "input_ids", "position_ids"])


def write_matrix(packed: DataFrame, path: str) -> None:
    packed.write.mode("overwrite").option("compression", "zstd").parquet(path)


def op4_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "matrix")
    packed = token_matrix(table(spark, sf_dir, "documents"), load_ranks())
    write_matrix(packed, path)
    return spark.read.schema(packed.schema).parquet(path)
