"""Line quality: a linear-chain conditional random field marks each line as content or boilerplate.

The field has two labels, a weight vector over line features for each and a transition matrix. It is trained by maximum
likelihood on the lines of at most TRAIN_DOCS labelled documents (in the order of a hash of doc_id), cut into chains of
TRAIN_LINES lines; all their lines if these are no more than TRAIN_CHAINS chains, else so many chains from anywhere in them (in the
order of a hash). Features are made in tasks and only they reach the driver, as Arrow buffers. A label says whether a document is content
on the whole, not which of its lines are, so lines are latent: the field is first trained without transitions on the
documents' labels, then, PASSES times, each line gets its more probable label under the field and the field is trained on
these. The document's label stays as a constraint on the sum: at least LEAST_SHARE of the words of a good document are in
content lines, and less than that of a bad one's; the lines nearest to the other label give way. So lines with different
labels stand in one document, and the chain learns how often labels change.

Every text is then decoded by Viterbi, the documents of an Arrow batch together (features take about 60 bytes for a character
of CHUNK, or of the longest line if that is longer), and is kept if at least LEAST_SHARE of its
words are in content lines.

Base figures follow their contract and are exact: five-word windows are compared by dense ids, not by hashes.

Defined cases: null text has no words and fails the base rules. Without labels, or with labels of one kind only, every
line is content. Ties in decoding go to content. Repeated rows each get a row; a repeated label row counts once, and of
two labels of a document the higher counts; of two texts of a labelled doc_id the first in order. Columns other than doc_id
and text (labels: doc_id, quality) are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

#: Bounds of the labelled sample: documents, lines of a training chain, and chains.
TRAIN_DOCS = 2_000
TRAIN_LINES = 64
TRAIN_CHAINS = 4_000
PASSES, ROUNDS, RATE, DECAY = 2, 100, 0.1, 1e-3
LEAST_SHARE = 0.5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
N_FEATURES = 14
#: Characters whose features are made at once; lines are never cut.
CHUNK = 1_000_000
#: Longer documents are decoded one at a time.
TOGETHER = 64


def base_figures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()
    seen: set[bytes] = set()
    dup = 0
    for line in data.split(b"\n"):
        if line and not line.isspace():
            dup += line in seen
            seen.add(line)
    return len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup, _repeat_words(words)


def _repeat_words(words: list[bytes]) -> int:
    n = len(words)
    if n < 6:
        return 0
    number: dict[bytes, int] = {}
    one = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    two = _dense(one[:-1] * n + one[1:])
    four = _dense(two[:-2] * n + two[2:])
    _, at, count = np.unique(four[:-1] * n + one[4:], return_inverse=True, return_counts=True)
    step = np.zeros(n + 1, np.int64)
    often = np.flatnonzero(count[at] > 1)
    np.add.at(step, often, 1)
    np.add.at(step, often + 5, -1)
    return int((np.cumsum(step) > 0).sum())


def _dense(codes: np.ndarray) -> np.ndarray:
    return np.unique(codes, return_inverse=True)[1]


#: Bits of a character's class.
_WORD, _LETTER, _DIGIT, _UPPER, _SYMBOL, _STOP, _LOUD, _SIGN = (1 << k for k in range(8))


def _classes() -> np.ndarray:
    """Class bits by code point; above the table all are letters in words."""
    out = np.zeros(0x600, np.uint8)
    for code in range(len(out)):
        c = chr(code)
        bits = 0 if c.isspace() else _WORD
        bits |= _LETTER if code > 127 and not c.isspace() or c.isalpha() or code < 32 and not c.isspace() or code == 127 else 0
        bits |= _DIGIT if c in "0123456789" else 0
        bits |= _UPPER if c.lower() != c else 0
        bits |= _SYMBOL if c in SYMBOLS else 0
        bits |= _STOP if c in ".!?" else 0
        bits |= _LOUD if c in "!?#*$%&|" else 0
        bits |= _SIGN if c in "@\xa9" else 0
        out[code] = bits
    return out


_CLASS = _classes()
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[ends] - total[starts]


def _holds(low: np.ndarray, text: str) -> np.ndarray:
    """Where `text` begins in the lower-cased code points."""
    hit = np.zeros(len(low), bool)
    n = len(low) - len(text) + 1
    if n > 0:
        hit[:n] = np.logical_and.reduce([low[k : n + k] == ord(c) for k, c in enumerate(text)])
    return hit


def _line_batch(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, word count and hash of each line; the feature for lines seen before is left at 0."""
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    code = np.frombuffer(("\n".join(lines) + "\n").encode("utf-32-le", "replace"), np.uint32)
    kind = np.where(code < len(_CLASS), _CLASS[np.minimum(code, len(_CLASS) - 1)], np.uint8(_WORD | _LETTER))
    blank = ((code >= 0x2000) & (code <= 0x200A)) | np.isin(code, (0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
    kind[blank] = 0
    count = lambda bit: _sums(kind & bit > 0, starts, ends)
    in_word = kind & _WORD > 0
    edge = np.diff(np.concatenate([[False], in_word]).astype(np.int8))
    first = np.flatnonzero(edge == 1)
    last = np.flatnonzero(np.diff(np.concatenate([in_word, [False]]).astype(np.int8)) == -1)
    of = np.searchsorted(ends, first)
    n = np.bincount(of, minlength=len(lines))
    one = np.maximum(n, 1)
    # hashes of words and lines: sums of a character's value times a power of its place
    width = int(max((last - first).max(initial=0), lengths.max(initial=0))) + 1
    power = np.cumprod(np.full(width + 1, _STEP, np.uint64))
    value = code.astype(np.uint64) + np.uint64(1)

    def run(begin: np.ndarray, end: np.ndarray, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return total[end] - total[begin]

    line_hash = run(starts, ends, value * power[np.arange(len(code)) - np.repeat(starts, lengths + 1)])
    word_hash = run(first, last + 1, value * power[np.where(in_word, _since(first, len(code)), 0)])
    same = (word_hash[1:] == word_hash[:-1]) & (of[1:] == of[:-1])
    mixed = np.unique((word_hash ^ (word_hash >> np.uint64(31))) * _STEP + of.astype(np.uint64), return_index=True)[1]
    low = np.where(kind & _UPPER > 0, code + 32, code)
    marked = _sums((kind & _SIGN > 0) | _holds(low, "http") | _holds(low, "licen"), starts, ends) > 0
    letters, alpha = count(_WORD), count(_LETTER)
    at_end = np.zeros(len(lines), np.int64)
    np.maximum.at(at_end, of, last)
    out = np.zeros((len(lines), N_FEATURES))
    out[:, 0] = 1
    out[:, 1] = n == 0
    some = n > 0
    wide = np.maximum(letters, 1)
    out[:, 2] = np.minimum(n, 100) / 100
    out[:, 3] = count(_SYMBOL) / one
    out[:, 4] = np.where(some, (letters - alpha) / wide, 0)
    out[:, 5] = count(_DIGIT) / np.maximum(lengths, 1)
    out[:, 6] = count(_UPPER) / np.maximum(alpha, 1)
    out[:, 7] = np.minimum(letters / one, 20) / 20
    out[:, 8] = np.bincount(of[mixed], minlength=len(lines)) / one
    out[:, 9] = np.bincount(of[1:][same], minlength=len(lines)) / one
    out[:, 10] = some & (kind[at_end] & _STOP > 0)
    out[:, 12] = marked
    out[:, 13] = np.bincount(of, kind[last] & _LOUD > 0, len(lines)) / one
    return out, n, line_hash


def _since(first: np.ndarray, size: int) -> np.ndarray:
    """For each place, how far behind the latest of the ascending places `first` it is."""
    latest = np.zeros(size, np.int64)
    latest[first] = first
    return np.arange(size) - np.maximum.accumulate(latest)


def batch_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and word count of every line of all texts, and the number of lines of each text."""
    lines = [(text or "").split("\n") for text in texts]
    counts = np.fromiter(map(len, lines), np.int64, len(lines))
    parts, part, held = [], [], 0
    for line in itertools.chain.from_iterable(lines):
        part.append(line)
        held += len(line) + 1
        if held >= CHUNK:
            parts.append(_line_batch(part))
            part, held = [], 0
    if part:
        parts.append(_line_batch(part))
    if not parts:
        return np.zeros((0, N_FEATURES)), np.zeros(0, np.int64), counts
    features, n_words, hashes = (np.concatenate(p) for p in zip(*parts, strict=True))
    text_of = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    keys = np.stack([text_of, hashes], 1).view([("t", np.uint64), ("h", np.uint64)]).ravel()
    features[:, 11] = n_words > 0
    features[np.unique(keys, return_index=True)[1], 11] = 0
    return features, n_words, counts


def line_lengths(texts: list[str | None]) -> np.ndarray:
    """Code points of every line of all texts."""
    lines = itertools.chain.from_iterable((text or "").split("\n") for text in texts)
    return np.fromiter(map(len, lines), np.int64)


def viterbi(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best labels (1 is content) for emission scores (lines x 2) and transition scores."""
    (b0, c0), back = scores[0], []
    bb, bc, cb, cc = move.ravel()
    for eb, ec in scores[1:].tolist():
        to_b, to_c = c0 + cb >= b0 + bb, c0 + cc >= b0 + bc
        back.append((to_b, to_c))
        b0, c0 = (c0 + cb if to_b else b0 + bb) + eb, (c0 + cc if to_c else b0 + bc) + ec
    now = int(c0 >= b0)
    out = [now]
    for to_b, to_c in reversed(back):
        now = int(to_c if now else to_b)
        out.append(now)
    return np.array(out[::-1])


def decode(scores: np.ndarray, counts: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best labels of the lines of several texts, each with `counts` lines."""
    out = np.zeros(len(scores), np.int64)
    starts = np.cumsum(counts) - counts
    for k in np.flatnonzero(counts > TOGETHER).tolist():
        out[starts[k] : starts[k] + counts[k]] = viterbi(scores[starts[k] : starts[k] + counts[k]], move)
    chains = _Chains(starts[counts <= TOGETHER], counts[counts <= TOGETHER])
    best, back = scores.copy(), np.zeros((len(scores), 2), bool)
    for k in range(1, len(chains.at)):
        here = chains.at[k]
        before = best[chains.at[k - 1][: len(here)]]
        from_b, from_c = before[:, :1] + move[0], before[:, 1:] + move[1]
        back[here] = from_c >= from_b
        best[here] = scores[here] + np.maximum(from_b, from_c)
    for k in range(len(chains.at) - 1, -1, -1):
        here = chains.at[k]
        ahead = chains.at[k + 1] if k + 1 < len(chains.at) else here[:0]
        out[here] = best[here, 1] >= best[here, 0]
        out[here[: len(ahead)]] = back[ahead, out[ahead]]
    return out


class _Chains:
    """Places of the first, second, ... lines of sequences, longest sequence first, so that each step is one slice."""

    def __init__(self, starts: np.ndarray, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        starts, counts = starts[order], counts[order]
        self.at = [starts[: np.searchsorted(-counts, -k, "left")] + k for k in range(int(counts.max(initial=0)))]
        self.last = starts + counts - 1


def _marginals(e: np.ndarray, move: np.ndarray, chains: _Chains, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(label) of each line, and the expected number of each transition. seq: each line's place in chains.last."""
    fwd, bwd = e.copy(), np.zeros_like(e)
    for k in range(1, len(chains.at)):
        here = chains.at[k]
        before = fwd[chains.at[k - 1][: len(here)]]
        fwd[here] += np.logaddexp(before[:, :1] + move[0], before[:, 1:] + move[1])
    for k in range(len(chains.at) - 1, 0, -1):
        here = chains.at[k]
        ahead = e[here] + bwd[here]
        bwd[chains.at[k - 1][: len(here)]] = np.logaddexp(ahead[:, :1] + move[:, 0], ahead[:, 1:] + move[:, 1])
    z = np.logaddexp(fwd[chains.last, 0], fwd[chains.last, 1])[seq]
    node = np.exp(np.minimum(fwd + bwd - z[:, None], 0))
    inner = np.flatnonzero(seq[1:] == seq[:-1])
    both = fwd[inner][:, :, None] + move + (e + bwd)[inner + 1][:, None, :] - z[inner][:, None, None]
    return node, np.exp(np.minimum(both, 0)).sum(0)


def train(features: np.ndarray, n_words: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x 2) and transitions (from x to), from the lines of documents with `counts` lines and a label each."""
    weight, move = np.zeros((features.shape[1], 2)), np.zeros((2, 2))
    document = np.repeat(np.arange(len(counts)), counts)
    if len(set(labels[counts > 0].tolist())) < 2:
        return weight, move
    cut = np.arange(len(features)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = np.flatnonzero(cut % TRAIN_LINES == 0)
    sizes = np.diff(np.append(begins, len(features)))
    chains = _Chains(begins, sizes)
    seq = np.empty(len(features), np.int64)
    seq[np.concatenate(chains.at)] = np.concatenate([np.arange(len(a)) for a in chains.at])
    gold = labels[document]
    for turn in range(passes + 1):
        _ascend(features, gold, chains, seq, weight, move, rounds, turn > 0)
        node, _ = _marginals(features @ weight, move, chains, seq)
        if turn < passes:
            gold = _constrained(node[:, 1], n_words, document, labels)
    return weight, move


def _ascend(x: np.ndarray, gold: np.ndarray, chains: _Chains, seq: np.ndarray, weight: np.ndarray, move: np.ndarray, rounds: int, chained: bool) -> None:
    """Gradient ascent on the log-likelihood of the lines' labels, in place; without transitions if not `chained`."""
    wanted = np.eye(2)[gold]
    inner = seq[1:] == seq[:-1]
    moves = np.zeros((2, 2))
    np.add.at(moves, (gold[:-1][inner], gold[1:][inner]), 1)
    m1, m2 = [0.0, 0.0], [0.0, 0.0]
    for t in range(1, rounds + 1):
        node, pair = _marginals(x @ weight, move, chains, seq)
        grads = [x.T @ (wanted - node) / len(x) - DECAY * weight, ((moves - pair) / len(x) - DECAY * move) * chained]
        for k, (p, g) in enumerate(zip((weight, move), grads, strict=True)):
            m1[k], m2[k] = 0.9 * m1[k] + 0.1 * g, 0.999 * m2[k] + 0.001 * g * g
            p += RATE * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.999**t)) + 1e-8)


def _constrained(content: np.ndarray, n_words: np.ndarray, document: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The more probable label of each line, where a document's lines together agree with its label; else the lines nearest to the other label give way."""
    total = np.bincount(document, n_words, len(labels))
    good = labels[document] == 1
    # in the order in which lines would become content: those of a good document up to the share it needs, of a bad one below it
    order = np.lexsort((-content, document))
    share = np.cumsum(n_words[order])
    share = share - np.concatenate([[0], np.cumsum(total)])[document[order]].astype(share.dtype)
    before, after = np.empty(len(content)), np.empty(len(content))
    before[order], after[order] = share - n_words[order], share
    need = LEAST_SHARE * total[document]
    return np.where(good, (content >= 0.5) | (before < need), (content >= 0.5) & (after < need)).astype(np.int64)


def labelled_lines(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_chains: int = TRAIN_CHAINS) -> tuple[np.ndarray, ...]:
    """Features, word counts and code points of the lines of the labelled sample, the number of lines of each document, and its label.

    A document's lines are whole chains of TRAIN_LINES (its last one may be shorter), in order.
    """
    rows = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1))
    sample = rows.groupBy("id").agg(F.max("y").cast("int").alias("y")).orderBy(F.xxhash64("id"), "id").limit(train_docs)
    names = ["id", "y", "chain", "features", "words", "chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, key, y in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lines = [text.as_py() or ""]
                features, n_words, counts = batch_features(lines)
                chars = line_lengths(lines)
                ends = np.append(np.arange(0, counts[0], TRAIN_LINES), counts[0])
                lists = [pa.ListArray.from_arrays(pa.array(ends * k, pa.int32()), pa.array(v.ravel())) for v, k in ((features.astype(np.float32), N_FEATURES), (n_words.astype(np.int32), 1), (chars.astype(np.int32), 1))]
                k = len(ends) - 1
                yield pa.RecordBatch.from_arrays([pa.array([key] * k, pa.string()), pa.array([y] * k, pa.int32()), pa.array(np.arange(k)), *lists], names)

    texts = docs.select(F.col("doc_id").alias("d"), F.col("text").cast("string").alias("t"))
    got = texts.join(F.broadcast(sample), F.col("d") == F.col("id")).groupBy(F.col("id").cast("string").alias("id")).agg(F.min("t").alias("t"), F.max("y").alias("y"))  # at most train_docs rows
    chains = got.select("t", "id", "y").mapInArrow(run, "id string, y int, chain long, features array<float>, words array<int>, chars array<int>")
    held = chains.orderBy(F.xxhash64("id", "chain"), "id", "chain").limit(train_chains).toArrow().sort_by([("id", "ascending"), ("chain", "ascending")]).combine_chunks()
    flat = lambda name: np.concatenate([np.zeros(0, np.float32), *(c.flatten().to_numpy() for c in held.column(name).chunks)])
    sizes = np.array([0, *(len(x) for x in held.column("words"))], np.int64)[1:]
    ids = held.column("id").to_pylist()
    first = np.flatnonzero([k == 0 or ids[k] != ids[k - 1] for k in range(len(ids))]) if ids else np.zeros(0, np.int64)
    counts = np.add.reduceat(sizes, first) if len(first) else sizes
    y = held.column("y").to_numpy().astype(np.int64)[first]
    return flat("features").reshape(-1, N_FEATURES).astype(float), flat("words").astype(np.int64), flat("chars").astype(np.int64), counts, y


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """The field of at most `train_docs` labelled documents."""
    features, n_words, _, counts, y = labelled_lines(docs, labels, train_docs)
    return train(features, n_words, counts, y)


def line_labels(texts: list[str | None], field: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The label and word count of every line of all texts, and the number of lines of each text."""
    features, n_words, counts = batch_features(texts)
    return decode(features @ field[0], counts, field[1]), n_words, counts


def line_quality(docs: DataFrame, field: tuple[np.ndarray, np.ndarray], least_share: float = LEAST_SHARE) -> DataFrame:
    """doc_id, the base figures, base_failed, kept, n_content_lines, content_share; a row for each row of docs."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column(0).to_pylist()
                figures = np.array([base_figures(t) for t in texts], np.int64).reshape(-1, 5)
                label, n_words, counts = line_labels(texts, field)
                of = np.repeat(np.arange(len(texts)), counts)
                content = np.bincount(of, label, len(texts)).astype(np.int64)
                share = np.bincount(of, label * n_words, len(texts)) / np.maximum(np.bincount(of, n_words, len(texts)), 1)
                failed = (figures[:, 0] < 10) | (100 * figures[:, 4] > 20 * figures[:, 0])
                columns = [batch.column(1), *[pa.array(figures[:, k]) for k in range(5)], pa.array(failed), pa.array(~failed & (share >= least_share)), pa.array(content), pa.array(share, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names, "base_failed", "kept", "n_content_lines", "content_share"])

    longs = [T.StructField(n, T.LongType()) for n in names]
    schema = T.StructType([docs.schema["doc_id"], *longs, T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("n_content_lines", T.LongType()), T.StructField("content_share", T.DoubleType())])
    return docs.select(F.col("text").cast("string"), "doc_id").mapInArrow(run, schema)


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_quality(docs, fit(docs, table(spark, sf_dir, "labels")))
