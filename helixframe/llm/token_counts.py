"""Token counts under a unigram model, with one forward pass for each shared prefix.

A pre-token is a word with a mark in front. The distinct pre-tokens of a batch are inserted in a trie by sorting them: in
that order each word keeps the trie path it shares with the word before, and forward scores (best log-probability of any
segmentation of the prefix, and its number of pieces) are computed only for the nodes that are new. At a node the pieces
that end there are found by walking back through a trie of the reversed pieces, which stops where no piece goes on. The
terminal node's count is stored and used for each occurrence. Counts of words seen before are kept by the worker up to
CACHE_WORDS.

Pieces come from a public vocabulary, read on the driver and broadcast (a file of fixed size). It has no probabilities, so
they are fitted to the corpus, in a pass of their own over all texts: every text is segmented into the fewest pieces, the
pieces' occurrences are added up by Spark (a row for each piece of the vocabulary at most), and a piece's probability is its
share of them, with ALPHA added to each count. A character outside the vocabulary falls back to its UTF-8 bytes, a token
each; the 256 bytes share the occurrences of such tokens alike. Ties go to fewer tokens. Text is not normalised.

Defined cases: null or blank text has 0 words and 0 tokens. An empty corpus leaves all pieces alike. Repeated rows each get a
row and count each. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Added to each piece's occurrences.
ALPHA = 0.5
CACHE_WORDS = 300_000
#: Longer words are counted anew each time.
CACHE_CHARS = 64
#: Characters that are worked on at once.
CHUNK = 2_000_000
#: The key of byte tokens among the pieces; no piece is empty.
BYTES = ""


def load_pieces(path: str = PIECES) -> list[str]:
    """The vocabulary without control, byte and unused pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def alike(pieces: list[str]) -> dict[str, float]:
    """Log-probabilities under which the best segmentation has the fewest tokens."""
    return dict.fromkeys([*pieces, BYTES], -1.0)


def reversed_trie(scores: dict[str, float]) -> dict:
    """A node is a dict from the character before to the next node; under BYTES it has the score of the piece that begins there."""
    root: dict = {}
    for piece, score in scores.items():
        if piece != BYTES:
            node = root
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[BYTES] = score
    return root


def segment_words(words: list[str], scores: dict[str, float], trie: dict) -> Iterator[tuple[str, int, list[int]]]:
    """(word, tokens, back) of each distinct word, along the trie of all of them; the last token begins at back[-1], the one before it at back[back[-1]], and so on."""
    byte = scores[BYTES]
    path, score, count, back = "", [0.0], [0], [0]
    for word in sorted(set(words)):
        marked = MARK + word
        shared = 0
        for a, b in zip(path, marked, strict=False):
            if a != b:
                break
            shared += 1
        del score[shared + 1 :], count[shared + 1 :], back[shared + 1 :]
        for j in range(shared + 1, len(marked) + 1):
            i = j - 1
            n_bytes = len(marked[i].encode("utf-8", "replace"))
            best, tokens, begin = score[i] + n_bytes * byte, count[i] + n_bytes, -i - 1
            node = trie
            while i >= 0:
                node = node.get(marked[i])
                if node is None:
                    break
                p = node.get(BYTES)
                if p is not None:
                    s = score[i] + p
                    if s > best or s == best and count[i] + 1 < tokens:
                        best, tokens, begin = s, count[i] + 1, i
                i -= 1
            score.append(best)
            count.append(tokens)
            back.append(begin)
        path = marked
        yield word, count[-1], back


def count_words(words: list[str], scores: dict[str, float], trie: dict | None = None) -> dict[str, int]:
    """Tokens of each distinct word."""
    return {word: tokens for word, tokens, _ in segment_words(words, scores, reversed_trie(scores) if trie is None else trie)}


def pieces_of(word: str, back: list[int]) -> list[str]:
    """The tokens of a word from segment_words(), last first; BYTES for each byte token."""
    marked, j, out = MARK + word, len(word) + len(MARK), []
    while j:
        i = back[j]
        if i < 0:
            i = -i - 1
            out += [BYTES] * len(marked[i].encode("utf-8", "replace"))
        else:
            out.append(marked[i:j])
        j = i
    return out


def _chunks(batch: pa.RecordBatch) -> Iterator[list[list[str]]]:
    """The words of each text of the batch, in groups of about CHUNK characters."""
    part, size = [], 0
    for value in batch.column(0):
        text = value.as_py() or ""
        part.append(text.split())
        size += len(text)
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def piece_counts(docs: DataFrame, pieces: list[str]) -> DataFrame:
    """(piece, n): occurrences in all texts when each is cut into the fewest pieces."""
    scores = alike(pieces)
    shared = docs.sparkSession.sparkContext.broadcast(scores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, total, waiting = reversed_trie(shared.value), Counter(), Counter()

        def settle() -> None:
            for word, _, back in segment_words(list(waiting), shared.value, trie):
                n = waiting[word]
                for piece in pieces_of(word, back):
                    total[piece] += n
            waiting.clear()

        for batch in batches:
            for part in _chunks(batch):
                for words in part:
                    waiting.update(words)
                if len(waiting) > CACHE_WORDS:
                    settle()
        settle()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["piece", "n"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, pieces: list[str]) -> dict[str, float]:
    """Log-probability of each piece, and under BYTES of a byte, from all of `docs`."""
    known = {r["piece"]: r["n"] for r in piece_counts(docs, pieces).collect()}  # a row for each piece at most
    total = sum(known.values()) + ALPHA * (len(pieces) + 256)
    scores = {piece: math.log((known.get(piece, 0) + ALPHA) / total) for piece in pieces}
    return scores | {BYTES: math.log((known.get(BYTES, 0) / 256 + ALPHA) / total)}


def token_counts(docs: DataFrame, scores: dict[str, float]) -> DataFrame:
    """doc_id, n_words, n_tokens; a row for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(scores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = reversed_trie(shared.value)
        cache: dict[str, int] = {}
        for batch in batches:
            n_words, n_tokens = [], []
            for part in _chunks(batch):
                new = {w for words in part for w in words}.difference(cache)
                if len(cache) + len(new) > CACHE_WORDS:
                    cache = {}
                    new = {w for words in part for w in words}
                counts = count_words(list(new), shared.value, trie)
                long = {w: counts.pop(w) for w in new if len(w) > CACHE_CHARS}
                cache.update(counts)
                count = cache.__getitem__ if not long else lambda w, long=long, cache=cache: long[w] if w in long else cache[w]
                n_words += map(len, part)
                n_tokens += [sum(map(count, words)) for words in part]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return docs.select(F.col("text").cast("string"), "doc_id").mapInArrow(run, schema)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts(docs, fit(docs, load_pieces()))
