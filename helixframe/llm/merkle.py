"""Merkle manifest of a dataset: append logs of hash trees in postorder, and a proof of inclusion for every row.

Each row is a leaf, a hash of its columns. The leaves of a source form a tree of FAN children a node, and the roots of the
sources form one more tree above them. Only ids and hashes are sorted: leaves are ranked over the cluster by (source, doc_id,
leaf) through range partitions and their sizes, so a source that holds a third of all rows is many partitions.

Ranks fix each leaf's aligned block of FAN ** LEVELS leaves. A builder takes the leaves of one block in order and appends every
node to the block's log as soon as its last child is there, that is in postorder: no node is ever moved, and a builder holds at
most FAN - 1 open nodes a level. Block roots are the leaves of the next tier, until each tree is one block. Logs are Parquet
tables in the shared folder, a row for each block, so a lost task appends the same block again.

A proof needs no tree in memory and no join by level. Of a log the place of any node follows from subtree sizes alone
(`places`): so a reader of a block looks up the siblings of all its leaves by their places, and appends what the tier above
gives for the whole block. Tiers are read from the top, each joined with one that has FAN ** LEVELS times fewer rows.

Defined cases: any null is `-`. Rows of one doc_id are ordered by leaf; equal rows are leaves of their own, with proofs of
their own. Null doc_id come first, null source is a source. An empty table has no leaf and no root. Columns other than the five
named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ranked, stored, table

FAN = 3
#: Levels of a block: a log row has 243 leaves and 364 nodes at most, about 25 KB.
LEVELS = 5
HASH = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: string, right: string>>"


def leaf(**changed: Column) -> Column:
    """The leaf of a row, in hexadecimal digits; `changed` replaces columns by others."""

    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, FIELDS)).cast("binary"), 256)


def levels(leaves: int) -> int:
    """Levels above the leaves of a whole tree."""
    top = 0
    while FAN**top < leaves:
        top += 1
    return top


def places(level: int, index: np.ndarray, leaves: int, top: int) -> np.ndarray:
    """Where the nodes `index` of a level stand in the postorder log of a tree with so many leaves and levels.

    When a node's last leaf is there, the log has what is complete by then: of each level j, leaves so far // FAN ** j nodes, those
    above the node's own level not counting any that this leaf completes as well. The last nodes of levels that have no whole
    number of runs come after all others, lowest level first.
    """
    last = (index + 1) * FAN**level
    whole = sum((last - (j > level)) // FAN**j for j in range(top + 1)) - 1
    even = max(j for j in range(top + 1) if leaves % FAN**j == 0)
    ragged = sum(leaves // FAN**j for j in range(top + 1)) + level - even - 1
    return np.where(last <= leaves, whole, ragged)


def _parent(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def append_nodes(leaves: list[str], top: int) -> list[str]:
    """All nodes of a tree of `top` levels, in the order in which they are complete."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(top)]

    def add(level: int, node: str) -> None:
        log.append(node)
        if level < top:
            waiting[level].append(node)
            if len(waiting[level]) == FAN:
                close(level)

    def close(level: int) -> None:
        node = _parent(waiting[level])
        waiting[level].clear()
        add(level + 1, node)

    for node in leaves:
        add(0, node)
    for level in range(top):
        if waiting[level]:
            close(level)
    return log


def _block_size(n: int, block: int, height: int) -> tuple[int, int]:
    """Leaves and levels of a block of a tree that has n leaves, where blocks have `height` levels."""
    size = FAN**height
    return (n, levels(n)) if n <= size else (min(size, n - block * size), height)


def _build(rows: DataFrame, height: int) -> DataFrame:
    """(tree, place, n, hash, what) to the log (tree, block, n, nodes, what): a row for each aligned block, by one builder."""
    kind = rows.schema["what"].dataType
    types = [T.StructField(c, T.LongType()) for c in ("tree", "block", "n")]
    schema = T.StructType([*types, T.StructField("nodes", T.BinaryType()), T.StructField("what", T.ArrayType(kind))])

    def row(key: tuple[int, int, int], hashes: list[bytes], what: list[pa.Array]) -> pa.RecordBatch:
        _, top = _block_size(key[2], key[1], height)
        log = b"".join(map(bytes.fromhex, append_nodes([h.hex() for h in hashes], top)))
        own = pa.concat_arrays(what)
        lists = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
        return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in key), pa.array([log], pa.binary()), lists], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hashes, what = None, [], []
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            own = batch.column(3).to_pylist()
            cuts = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
            for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if a == b:
                    continue
                if key not in (None, keys[a]):
                    yield row(key, hashes, what)
                    hashes, what = [], []
                key = keys[a]
                hashes += own[a:b]
                what.append(batch.column(4).slice(a, b - a))
        if key is not None:
            yield row(key, hashes, what)

    block = F.floor(F.col("place") / F.lit(FAN**height)).alias("block")
    dealt = rows.select("tree", block, "n", "hash", "what", "place").repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
    return stored(dealt.drop("place").mapInArrow(run, schema))


def _tiers(leaves: DataFrame, height: int) -> list[DataFrame]:
    """The logs of all tiers, the leaves' first; leaves (tree, place, n, hash, what)."""
    size = FAN**height
    n = leaves.agg(F.max("n")).first()[0] or 0
    tiers = [_build(leaves, height)]
    while n > size:
        up = tiers[-1].where(F.col("n") > size).select("tree", F.col("block").alias("place"), F.ceil(F.col("n") / size).alias("n"), F.substring("nodes", -HASH, HASH).alias("hash"), F.lit(None).cast("string").alias("what"))
        tiers.append(_build(up, height))
        n = -(-n // size)
    return tiers


def _roots(tiers: list[DataFrame], height: int) -> DataFrame:
    """(tree, root): each tree's root, which is the last node of the log of its only block on some tier."""
    out = None
    for log in tiers:
        own = log.where(F.col("n") <= FAN**height).select("tree", F.substring("nodes", -HASH, HASH).alias("root"))
        out = own if out is None else out.unionByName(own)
    return out


def _siblings(nodes: bytes, leaves: int, top: int) -> list[list[tuple[str, str]]]:
    """For each leaf of a block its siblings to the left and right, level by level, found by their places in the log."""
    text = nodes.hex()
    by_level = []
    for level in range(top):
        count = -(-leaves // FAN**level)
        at = places(level, np.arange(count), leaves, top) * 2 * HASH
        own = [text[a : a + 2 * HASH] for a in at.tolist()]
        by_level.append([("".join(own[j - j % FAN : j]), "".join(own[j + 1 : j - j % FAN + FAN])) for j in range(count)])
    return [[by_level[level][i // FAN**level] for level in range(top)] for i in range(leaves)]


def _extract(log: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """(tree, place, hash, what, path) of every leaf of a tier; above: (tree, block, path) of its blocks."""
    kind = log.schema["what"].dataType.elementType
    path = T._parse_datatype_string(PATH)
    schema = T.StructType([T.StructField("tree", T.LongType()), T.StructField("place", T.LongType()), T.StructField("hash", T.StringType()), T.StructField("what", kind), T.StructField("path", path)])
    pairs = pa.struct([("left", pa.string()), ("right", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            what = batch.column(4)
            for k, (tree, block, n, nodes, up) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 5)), strict=True)):
                leaves, top = _block_size(n, block, height)
                local = _siblings(nodes, leaves, top)
                text = nodes.hex()
                at = (places(0, np.arange(leaves), leaves, top) * 2 * HASH).tolist()
                rest = [(p["left"], p["right"]) for p in up]
                left, right = ([x[side] for own in local for x in (*own, *rest)] for side in (0, 1))
                offsets = pa.array(np.arange(leaves + 1) * (top + len(rest)), pa.int32())
                paths = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], fields=list(pairs)))
                place = pa.array(block * FAN**height + np.arange(leaves), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([tree] * leaves, pa.int64()), place, pa.array([text[a : a + 2 * HASH] for a in at]), what[k].values, paths], schema.names)

    return log.join(above, ["tree", "block"]).select("tree", "block", "n", "nodes", "what", "path").mapInArrow(run, schema)


def _paths(tiers: list[DataFrame], roots: DataFrame, height: int) -> DataFrame:
    """(tree, place, hash, what, path) of the leaves of the first tier; roots: (tree, path) from the trees' roots upwards."""
    found = None
    for k in range(len(tiers) - 1, -1, -1):
        single = tiers[k].where(F.col("n") <= FAN**height).select("tree", "block").join(roots, "tree")
        above = single if found is None else single.unionByName(found.select("tree", F.col("place").alias("block"), "path"))
        found = _extract(tiers[k], above, height)
        found = stored(found) if k else found
    return found


@dataclass
class Manifest:
    """The logs of the trees of all sources and of the tree above them, and (tree, source, n, subroot)."""

    tiers: list[DataFrame]
    top: list[DataFrame]
    sources: DataFrame
    root: str | None
    height: int


def manifest(docs: DataFrame, claim: Column | None = None, height: int = LEVELS) -> Manifest:
    """Builds all trees. `claim`, if given, is a leaf that goes along with each row, to be held against its proof; a block has `height` levels."""
    claimed = F.lit(None).cast("string") if claim is None else claim
    hashed = stored(docs.select("doc_id", "source", F.unhex(leaf()).alias("hash"), F.unhex(claimed).alias("claim")))
    rows = ranked(hashed, "source", "doc_id", "hash")
    of_source = rows.groupBy("source").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    sources = ranked(stored(of_source), "first").withColumnRenamed("rank", "tree").withColumnRenamed("source", "name")
    what = F.struct("doc_id", "claim").alias("what")
    tiers = _tiers(rows.join(sources, F.col("source").eqNullSafe(F.col("name"))).select("tree", (F.col("rank") - F.col("first")).alias("place"), "n", "hash", what), height)
    named = stored(sources.join(_roots(tiers, height), "tree").select("tree", F.col("name").alias("source"), "n", F.col("root").alias("subroot")))
    top = _tiers(named.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(sources.count()).cast("long").alias("n"), F.col("subroot").alias("hash"), F.lit(None).cast("string").alias("what")), height)
    root = _roots(top, height).select(F.lower(F.hex("root"))).first()
    return Manifest(tiers, top, named, root[0] if root else None, height)


def proofs(made: Manifest) -> DataFrame:
    """doc_id, source, leaf, claim, subroot, root, path: for every row its siblings (left, right) from the leaf's run to the root's."""
    above = made.top[0].sparkSession.sql(f"SELECT 0L AS tree, CAST(array() AS {PATH}) AS path")
    of_sources = stored(_paths(made.top, above, made.height).select(F.col("place").alias("tree"), "path"))
    found = _paths(made.tiers, of_sources, made.height).join(made.sources, "tree")
    digits = lambda c: F.lower(F.hex(c))
    return found.select("what.doc_id", "source", F.col("hash").alias("leaf"), digits("what.claim").alias("claim"), digits("subroot").alias("subroot"), F.lit(made.root).cast("string").alias("root"), "path")


def folded(start: Column, path: Column) -> Column:
    """The root to which a leaf and its siblings lead."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]).cast("binary"), 256))


def log_nodes(made: Manifest) -> DataFrame:
    """(tree, tier, block, place, node): the logs of the sources' trees, a row for each node at its place in its block's log."""
    out = None
    for tier, log in enumerate(made.tiers):
        places_of = F.sequence(F.lit(0), (F.octet_length("nodes") / HASH).cast("int") - 1)
        rows = log.select("tree", F.lit(tier).alias("tier"), "block", "nodes", F.explode(places_of).alias("place"))
        rows = rows.select("tree", "tier", "block", "place", F.lower(F.hex(F.substring(F.col("nodes"), F.col("place") * HASH + 1, F.lit(HASH)))).alias("node"))
        out = rows if out is None else out.unionByName(rows)
    return out


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = leaf(text=F.translate("text", "\n", ""))
    docs = table(spark, sf_dir, "documents")
    claim = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, tampered)
    got = proofs(manifest(docs, claim))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)
    got = got.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded(F.coalesce("claim", "leaf"), F.col("path")).alias("folded_root"))
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


SQL = r"""
WITH RECURSIVE even AS (
  SELECT doc_id, list_reduce([4294967295] || list_transform(range(len(s)), lambda k: CAST(ascii(s[k + 1]) AS BIGINT)),
    lambda c, b: list_reduce([xor(c, b)] || range(8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))) & 1 = 1 AS tampered
  FROM (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL)
), field AS (
  SELECT doc_id, source, text, concat(
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head FROM documents
), made AS (
  SELECT f.doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, CASE WHEN tampered
    THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS claim
  FROM field f LEFT JOIN even ON f.doc_id = even.doc_id
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM made
), low AS (
  SELECT 0 AS lvl, tree, place, leaf AS h FROM placed
  UNION ALL
  SELECT lvl + 1, tree, place // 3, sha256(string_agg(h, '' ORDER BY place)) FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM low) WHERE n > 1 GROUP BY lvl, tree, place // 3
), tops AS (SELECT tree, max(lvl) AS lvl FROM low GROUP BY tree),
subroots AS (SELECT low.tree, low.lvl, low.h FROM low JOIN tops ON low.tree = tops.tree AND low.lvl = tops.lvl),
high AS (
  SELECT 0 AS lvl, tree AS place, h FROM subroots
  UNION ALL
  SELECT lvl + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)) FROM (SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY lvl, place // 3
), runs AS (
  SELECT lvl, tree, place // 3 AS run, list(h ORDER BY place) AS hs FROM low GROUP BY lvl, tree, place // 3
), high_runs AS (SELECT lvl, place // 3 AS run, list(h ORDER BY place) AS hs FROM high GROUP BY lvl, place // 3),
steps AS (
  SELECT p.tree, p.place, r.lvl AS step, hs, (p.place // CAST(pow(3, r.lvl) AS BIGINT)) % 3 AS nth
  FROM placed p JOIN tops t ON p.tree = t.tree JOIN runs r ON r.tree = p.tree AND r.lvl < t.lvl AND r.run = p.place // CAST(pow(3, r.lvl + 1) AS BIGINT)
  UNION ALL
  SELECT p.tree, p.place, t.lvl + r.lvl, hs, (p.tree // CAST(pow(3, r.lvl) AS BIGINT)) % 3
  FROM placed p JOIN tops t ON p.tree = t.tree JOIN high_runs r ON r.lvl < (SELECT max(lvl) FROM high) AND r.run = p.tree // CAST(pow(3, r.lvl + 1) AS BIGINT)
), sides AS (SELECT tree, place, step, array_to_string(hs[1:nth], '') AS l, array_to_string(hs[nth + 2:], '') AS r FROM steps),
folds AS (
  SELECT tree, place, 0 AS step, coalesce(claim, leaf) AS h FROM placed
  UNION ALL
  SELECT f.tree, f.place, f.step + 1, sha256(l || h || r) FROM folds f JOIN sides s ON f.tree = s.tree AND f.place = s.place AND f.step = s.step
), ends AS (SELECT tree, place, max_by(h, step) AS h FROM folds GROUP BY tree, place),
proof AS (SELECT tree, place, sha256(string_agg(l || r, '' ORDER BY step)) AS sha FROM sides GROUP BY tree, place)
SELECT p.doc_id, p.leaf, s.h AS subroot, x.h AS root, coalesce(sha, sha256('')) AS proof_sha256, ends.h AS folded_root, ends.h = x.h AS verified
FROM placed p JOIN subroots s ON p.tree = s.tree JOIN ends ON p.tree = ends.tree AND p.place = ends.place
LEFT JOIN proof ON p.tree = proof.tree AND p.place = proof.place, (SELECT max_by(h, lvl) AS h FROM high) x
"""
