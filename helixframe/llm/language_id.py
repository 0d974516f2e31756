"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting is a Spark job: every task counts (language, bucket) pairs of its rows and a shuffle adds them up. The driver gets
the sums of one block of BLOCK languages at a time and makes a log-probability matrix of them, which is broadcast: a block is
2 ** BITS floats for each of its languages, whatever the corpus. Tasks score their Arrow batches with numpy. Up to BLOCK
languages are one pass; with more of them each block is a pass of its own over the texts, which carries the best language so
far and the sum of all likelihoods, so any number of labels gets its exact result.

Features are the 1-, 2- and 3-grams inside a word of letters, lower-cased, with one blank at either end. No feature
reaches over a gap between words, so a long text can be cut at gaps and scored in pieces with the same result.

Defined cases: null text, or text without a letter: language `und`, score 0. Ties go to the first language in
alphabetical order. No labelled row at all: `und` for every text. A null doc_id is not held out and is not learned from.
Repeated rows each get a row. Columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_row, checkpoint, from_row, table

#: 2 ** BITS hash buckets.
BITS = 16
GRAMS = (1, 2, 3)
#: Additive smoothing of the counts.
ALPHA = 0.1
#: Languages of one matrix, of 2 ** BITS floats each, that is broadcast.
BLOCK = 128
#: Characters that are worked on at once.
CHUNK = 1_000_000


@cache
def _letters() -> np.ndarray:
    """Code point -> lower-cased letter, or blank."""
    out = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        ch = chr(code)
        if ch.isalpha():
            low = ch.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of about CHUNK characters; a longer text is cut at blanks, and not at all if it has none."""
    rows, parts, size = [], [], 0
    for i, text in enumerate(texts):
        at, text = 0, text or ""
        while at < len(text) or at == 0:
            end = len(text)
            if end - at > CHUNK:
                cut = max(text.rfind(" ", at + 1, at + CHUNK), text.rfind("\n", at + 1, at + CHUNK))
                end = cut if cut > at else end
            rows.append(i)
            parts.append(text[at:end])
            size += end - at
            at = max(end, 1)
            if size >= CHUNK:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


def features(parts: list[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the index of the part and the bucket of each of its n-grams."""
    lengths = np.fromiter((len(p) + 2 for p in parts), np.int64, len(parts))
    codes = np.frombuffer("".join(f" {p} " for p in parts).encode("utf-32-le", "replace"), np.uint32)
    x = _letters()[codes]
    part = np.repeat(np.arange(len(parts), dtype=np.int32), lengths)
    blank = x == 32
    keep = np.ones(len(x), bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (part[1:] == part[:-1]))
    x, part, blank = x[keep].astype(np.uint64), part[keep], blank[keep]
    for n in GRAMS:
        if len(x) < n:
            continue
        h = np.full(len(x) - n + 1, n, np.uint64)
        good = part[n - 1 :] == part[: len(part) - n + 1]
        if n == 1:
            good &= ~blank
        for k in range(n):
            part_of = x[k : len(x) - n + 1 + k]
            h = (h ^ part_of) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if 0 < k < n - 1:
                good &= part_of != 32
        yield part[n - 1 :][good], (h[good] * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64)


def count_features(labelled: DataFrame, bits: int = BITS) -> DataFrame:
    """(lang, bucket, n) of rows (text, lang), and the number of texts as bucket -1."""

    def made(sums: dict[str, np.ndarray], docs: dict[str, int]) -> Iterator[pa.RecordBatch]:
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            columns = [pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], docs[lang]))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            texts = batch.column(0).to_pylist()
            for lang in sorted(set(langs)):
                if lang not in sums and len(sums) >= BLOCK:  # a task keeps no more than that; Spark adds the parts up
                    yield from made(sums, docs)
                    sums, docs = {}, {}
                mine = [t for t, v in zip(texts, langs, strict=True) if v == lang]
                docs[lang] = docs.get(lang, 0) + len(mine)
                total = sums.setdefault(lang, np.zeros(1 << bits, np.int64))
                for _, parts in _pieces(mine):
                    for _, bucket in features(parts, bits):
                        total += np.bincount(bucket, minlength=1 << bits)
        yield from made(sums, docs)

    parts = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(count, "lang string, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


Model = tuple[list[str], np.ndarray, np.ndarray]


def fit_blocks(labelled: DataFrame, bits: int = BITS, block: int = BLOCK) -> list[Model]:
    """Languages, log priors and log P(bucket | language) of each block of languages, from all rows with text and lang."""
    counts = checkpoint(count_features(labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()), bits))
    texts = sorted((r["lang"], r["n"]) for r in counts.where("bucket = -1").collect())  # a row for each language
    total = sum(n for _, n in texts)
    out = []
    for at in range(0, len(texts), block):
        langs = [lang for lang, _ in texts[at : at + block]]
        mine = counts.where((F.col("bucket") >= 0) & F.col("lang").between(langs[0], langs[-1])).toArrow()
        coded = mine.column("lang").combine_chunks().dictionary_encode()
        code = {lang: k for k, lang in enumerate(langs)}
        row = np.array([code[v] for v in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)
        table_ = np.full((len(langs), 1 << bits), ALPHA)
        table_[row, mine.column("bucket").to_numpy()] += mine.column("n").to_numpy()
        out.append((langs, np.log(np.array([n for _, n in texts[at : at + block]]) / total), np.log(table_ / table_.sum(1, keepdims=True)).astype(np.float32)))
    return out


def fit(labelled: DataFrame, bits: int = BITS) -> Model:
    """All languages as one block, for callers that know them to be few."""
    blocks = fit_blocks(labelled, bits, 1 << 30)
    return blocks[0] if blocks else ([], np.zeros(0), np.zeros((0, 1 << bits), np.float32))


def _likelihoods(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihoods (text x language), and the number of letters of each text."""
    langs, prior, table_ = model
    bits = int(table_.shape[1]).bit_length() - 1
    total = np.zeros((len(texts), len(langs)))
    letters = np.zeros(len(texts), np.int64)
    for rows, parts in _pieces(texts):
        rows = np.array(rows)
        for part, bucket in features(parts, bits):
            np.add.at(letters, rows, np.bincount(part, minlength=len(rows)))
            for k in range(len(langs)):
                np.add.at(total[:, k], rows, np.bincount(part, table_[k][bucket], len(rows)))
    return total + prior, letters


def score_texts(texts: list[str | None], langs: list[str], prior: np.ndarray, table_: np.ndarray) -> tuple[list[str], list[float]]:
    lang, best, log_sum = _score_block(texts, (langs, prior, table_), [None] * len(texts), np.full(len(texts), -np.inf), np.full(len(texts), -np.inf))
    return [v or "und" for v in lang], [float(np.exp(b - s)) if v else 0.0 for v, b, s in zip(lang, best, log_sum, strict=True)]


def _score_block(texts: list[str | None], model: Model, lang: list[str | None], best: np.ndarray, log_sum: np.ndarray) -> tuple[list[str | None], np.ndarray, np.ndarray]:
    """Language, its log-likelihood and the log of all likelihoods' sum, with those of earlier blocks; no language for texts without a letter."""
    if not model[0]:
        return lang, best, log_sum
    total, letters = _likelihoods(texts, model)
    top = total.argmax(1)
    value = total[np.arange(len(texts)), top]
    most = np.maximum(log_sum, value)
    log_sum = most + np.log(np.exp(log_sum - most) + np.exp(total - most[:, None]).sum(1))
    better = value > best
    lang = [model[0][t] if b and n else v for t, b, n, v in zip(top, better, letters, lang, strict=True)]
    return lang, np.maximum(best, value), log_sum


def identify(docs: DataFrame, models: list[Model], text: str = "text") -> DataFrame:
    """All columns of `docs` but `text`, then lang_pred and score, a row for each row."""
    sc = docs.sparkSession.sparkContext
    rest = [c for c in docs.columns if c != text]
    fields = [f for f in docs.schema.fields if f.name != text]
    done = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    so_far = [T.StructField("lang_pred", T.StringType()), T.StructField("best", T.DoubleType()), T.StructField("log_sum", T.DoubleType())]
    now = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"))
    kept = [T.StructField("text", T.StringType()), T.StructField("rest", T.StructType(fields))]
    models = models or [([], np.zeros(0), np.zeros((0, 2), np.float32))]

    def scorer(shared, last: bool):
        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(0).to_pylist()
                if batch.num_columns > 2:
                    state = batch.column(2).to_pylist(), batch.column(3).to_numpy(), batch.column(4).to_numpy()
                else:
                    state = [None] * len(texts), np.full(len(texts), -np.inf), np.full(len(texts), -np.inf)
                lang, best, log_sum = _score_block(texts, shared.value, *state)
                if last:
                    value = [float(np.exp(b - s)) if v else 0.0 for v, b, s in zip(lang, best, log_sum, strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([v or "und" for v in lang], pa.string()), pa.array(value, pa.float64())], ["rest", "lang_pred", "score"])
                else:
                    yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(lang, pa.string()), pa.array(best), pa.array(log_sum)], ["text", "rest", "lang_pred", "best", "log_sum"])

        return score

    for k, model in enumerate(models):
        last = k == len(models) - 1
        now = now.mapInArrow(scorer(sc.broadcast(model), last), T.StructType([kept[1], *done] if last else [*kept, *so_far]))
        if not last:
            now = checkpoint(now)  # so that no task holds the matrices of two blocks
    return now.select(*[F.col("rest")[c].alias(c) for c in rest], "lang_pred", "score")


def _fold(docs: DataFrame) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return docs.select("doc_id", "text", F.col("lang").alias("label"), F.coalesce(fold == 0, F.lit(False)).alias("held_out"), (fold != 0).alias("learn"))


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the four fifths of documents that are not held out."""
    folded = _fold(docs)
    models = fit_blocks(folded.where("learn").select("text", F.col("label").alias("lang")))
    return identify(folded.select("text", "doc_id", "held_out"), models)


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows of `docs` whose language is identified with a score of at least `least`; columns as they came."""
    folded = _fold(docs)
    models = fit_blocks(folded.where("learn").select("text", F.col("label").alias("lang")))
    wide = as_row(docs).select(F.col("row")["text"].alias("text"), "row")
    scored = identify(wide, models)
    return from_row(scored.where((F.col("lang_pred") != "und") & (F.col("score") >= least)), docs.columns)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))
