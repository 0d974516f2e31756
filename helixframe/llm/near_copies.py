"""The pipeline's near-duplicate stage: SimHash near-duplicates, completed by exact five-word Jaccard similarity of 0.8 or more.

First the fingerprints of five-word shingles are joined by the binary tries of simhash.py, and pairs within BITS bits are
candidates. At a similarity of 0.8 two 64-bit fingerprints differ in about 10 bits, though, and blocks of bits that would find
those are so short that each block's buckets hold a large share of all documents. So SimHash alone finds about half of such
pairs, and what it leaves apart is completed by candidates from MinHash bands. Every candidate link is verified on the shingle
sets themselves (64-bit hashes of the shingles), and components of verified links are joined further.

Distinct sets take the place of documents, so exact copies are one. A set goes to a bucket for each of its BANDS bands of
ROWS minima; two sets of similarity 0.8 share none with probability (1 - 0.8 ** ROWS) ** BANDS, 1 in 14,000, and at 0.9 with
less than 1 in 10 ** 9. Buckets that are one component by now need nothing. In the others all sets are compared with the smallest
one first. Buckets that are not one component after that have all their pairs of different components compared. Sets and
pairs that cannot be similar enough are left out of both: by their sizes, or because too many of the shingles of either stand
in no other set that is still in question. So a group of near copies costs a row a member and bucket, sets with much text of their own cost no
pairs, and of the pairs that share a bucket none that could join anything is left out.

Defined cases: a text of fewer than five words is one shingle; null and blank texts have the empty set and are copies of
each other. Of each component one row stays: the smallest doc_id, then the smallest hash of the row's columns. Rows of one
doc_id with texts that are no near copies are rows of different components. Rows without doc_id link others but cannot be
named, so all of them stay. Rows equal in every column are one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_row, from_row, stored
from .simhash import components, links, sign_bits

WIDTH = 5
#: Bits in which fingerprints of candidates differ at most.
BITS = 4
#: Least similarity, in hundredths.
PERCENT = 80
BANDS, ROWS = 24, 5

_odd = np.random.default_rng(5).integers(0, 1 << 63, (3, BANDS * ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_TIMES, _PLUS, _MIX = _odd[0][:, None], _odd[1][:, None], _odd[2].reshape(BANDS, ROWS)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles' hashes, ascending."""
    return np.unique(all_shingles(text, width))


def all_shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], 42) for a, b in cuts), np.uint64, len(words) - width + 1)


def band_keys(h: np.ndarray) -> np.ndarray:
    """A bucket for each band; none of the empty set."""
    if not len(h):
        return h
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), 4096):
        np.minimum(least, (h[at : at + 4096] * _TIMES + _PLUS).min(1), out=least)
    return (least.reshape(BANDS, ROWS) * _MIX).sum(1, dtype=np.uint64)


def _set_hash(h: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), np.int64).tolist())


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, doc_id, tie) to (doc_id, tie, h1, h2, n, fp, keys)."""
    for batch in batches:
        h1, h2, n, fp, keys = [], [], [], [], []
        for text in batch.column(0):
            every = all_shingles(text.as_py())
            h = np.unique(every)
            fp.append(sign_bits(every))
            a, b = _set_hash(h)
            h1.append(a)
            h2.append(b)
            n.append(len(h))
            keys.append(band_keys(h).view(np.int64))
        columns = [batch.column(1), batch.column(2), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(n, pa.int64()), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tie", "h1", "h2", "n", "fp", "keys"])


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, sid, h1, h2) to (sid, body), where the text is that of the set."""
    for batch in batches:
        sids, bodies = [], []
        for text, sid, h1, h2 in zip(batch.column(0), *(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            h = shingles(text.as_py())
            if _set_hash(h) == (h1, h2):
                sids.append(sid)
                bodies.append(h.view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(bodies, pa.list_(pa.int64()))], ["sid", "body"])


def _verified(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough."""
    left = bodies.select(F.col("sid").alias("a"), F.col("body").alias("of_a"))
    right = bodies.select(F.col("sid").alias("b"), F.col("body").alias("of_b"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return stored(both.where(shared * (100 + PERCENT) >= (F.size("of_a") + F.size("of_b")) * PERCENT).select("a", "b"))


def _own(bodies: DataFrame) -> DataFrame:
    """(sid, own): the shingles of each set that no other of these sets has; sets without any are left out."""
    spread = bodies.select("sid", F.explode("body").alias("shingle"))
    alone = spread.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets"), F.min("sid").alias("sid")).where("sets = 1")
    return alone.groupBy("sid").agg(F.count(F.lit(1)).alias("own"))


def _similar_sizes(n, m, both) -> Column:
    """Whether sets of n and m shingles, of which at most `both` are common, can be similar enough."""
    return both * (100 + PERCENT) >= (n + m) * PERCENT


def _by_fingerprint(sets: DataFrame) -> DataFrame:
    """(a, b): pairs of sets whose fingerprints are equal or at most BITS apart, enough of them to join all of these."""
    lead = stored(sets.groupBy("fp").agg(F.min("sid").alias("lead"), F.count(F.lit(1)).alias("sets")))
    of = lambda k: lead.select(F.col("fp").alias(k), F.col("lead").alias(f"lead_{k}"))
    apart = links(lead.select("fp"), BITS, direct=True).join(of("a"), "a").join(of("b"), "b").select(F.col("lead_a").alias("a"), F.col("lead_b").alias("b"))
    equal = sets.select("sid", "fp").join(lead.where("sets > 1"), "fp").where("sid <> lead").select(F.col("lead").alias("a"), F.col("sid").alias("b"))
    return stored(apart.unionByName(equal))


def _named(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """rows (key, centre, sid, n) of the buckets that are not one component, with each set's root."""
    named = stored(rows.join(roots, F.col("sid") == F.col("node"), "left").select("key", "centre", "sid", "n", F.coalesce("root", "sid").alias("root")))
    mixed = stored(named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key"))
    return stored(named.join(mixed, "key"))


def _in_question(rows: DataFrame, bodies: DataFrame) -> DataFrame:
    """rows (key, sid, n, root) without the sets that no other of them can be similar to, with `free`, the shingles that are not a set's own, and each bucket's smallest set as `centre`."""
    own = _own(bodies.join(rows.select("sid").distinct(), "sid", "left_semi"))
    free = F.col("n") - F.coalesce("own", F.lit(0))
    kept = stored(rows.join(own, "sid", "left").select("key", "sid", "n", "root", free.alias("free")).where(_similar_sizes(F.col("n"), F.col("free"), F.col("free"))))
    return stored(kept.join(stored(kept.groupBy("key").agg(F.min("sid").alias("centre"))), "key"))


def _roots(sets: DataFrame, bodies_of) -> DataFrame:
    """(node, root) of the sets (sid, n, fp, keys) that are linked to any other."""
    near = _by_fingerprint(sets)
    banded = sets.select("sid", "n", F.explode("keys").alias("key"))
    shared = stored(banded.groupBy("key").agg(F.min("sid").alias("centre"), F.count(F.lit(1)).alias("members")).where("members > 1").select("key", "centre"))
    rows = stored(banded.join(shared, "key"))
    wanted = rows.select("sid").unionByName(near.select(F.col("a").alias("sid"))).unionByName(near.select(F.col("b").alias("sid")))
    bodies = bodies_of(wanted.distinct())
    found = _verified(near, bodies)
    left = _in_question(_named(rows, components(found)), bodies)
    centres = left.where("sid = centre").select("centre", F.col("n").alias("m"), F.col("root").alias("other"), F.col("free").alias("free_c")).distinct()
    tried = left.where("sid <> centre").select("centre", "sid", "n", "root", "free").distinct().join(centres, "centre")
    tried = tried.where((F.col("root") != F.col("other")) & _similar_sizes(F.col("n"), F.col("m"), F.least("free", "free_c"))).select(F.col("centre").alias("a"), F.col("sid").alias("b"))
    found = found.unionByName(_verified(tried, bodies))
    roots = components(found)
    rest = _named(left.drop("root", "free"), roots).where("sid <> centre")  # pairs with the centre are verified already
    if rest.isEmpty():
        return roots
    rest = _in_question(rest, bodies)  # once more, since what only left-out sets shared with a set is its own now
    # a pair that shares several buckets is made in the first of them; a set has BANDS keys at most
    rest = stored(rest.join(stored(rest.groupBy("sid").agg(F.collect_set("key").alias("all_keys"))), "sid"))
    other = rest.select("key", F.col("sid").alias("b"), F.col("n").alias("m"), F.col("root").alias("other"), F.col("free").alias("free_b"), F.col("all_keys").alias("keys_b"))
    once = F.col("key") == F.array_min(F.array_intersect("all_keys", "keys_b"))
    pairs = rest.join(other, "key").where((F.col("root") < F.col("other")) & _similar_sizes(F.col("n"), F.col("m"), F.least("free", "free_b")) & once)
    pairs = pairs.select(F.least("sid", "b").alias("a"), F.greatest("sid", "b").alias("b"))
    return components(found.unionByName(_verified(pairs, bodies)))


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row of each component stays, with all its columns."""
    wide = as_row(docs).select("row", F.col("row")["doc_id"].alias("doc_id"), F.col("row")["text"].cast("string").alias("text"), F.xxhash64("row").alias("tie"))
    schema = T.StructType([wide.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("tie", "h1", "h2", "n", "fp")), T.StructField("keys", T.ArrayType(T.LongType()))])
    prints = wide.select("text", "doc_id", "tie").mapInArrow(_signed, schema)
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "tie"))).alias("first")
    grouped = prints.groupBy("h1", "h2").agg(first, F.min("tie").alias("one"), F.first("n").alias("n"), F.min("fp").alias("fp"), F.first("keys").alias("keys"))
    sets = stored(grouped.withColumn("sid", F.monotonically_increasing_id()))

    def bodies_of(wanted: DataFrame) -> DataFrame:
        texts = wide.select("text", "tie").join(sets.join(wanted, "sid", "left_semi").select("sid", "h1", "h2", F.col("one").alias("tie")), "tie")
        return stored(texts.select("text", "sid", "h1", "h2").mapInArrow(_bodies, "sid long, body array<long>").dropDuplicates(["sid"]))

    roots = _roots(sets.select("sid", "n", "fp", "keys"), bodies_of)
    named = sets.select("sid", "first").join(roots, F.col("sid") == F.col("node"), "left").select("first", F.coalesce("root", "sid").alias("root"))
    stay = stored(named.groupBy("root").agg(F.min("first").alias("first")).where("first IS NOT NULL").select("first.doc_id", "first.tie"))
    kept = wide.join(stay, ["doc_id", "tie"], "left_semi").dropDuplicates(["doc_id", "tie"]).select("row")
    return from_row(kept.unionByName(wide.where(F.col("doc_id").isNull()).select("row")), docs.columns)
