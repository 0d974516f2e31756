"""Main text of web pages, with suffix arrays over each host's page streams.

A page is parsed once, into blocks with a role each: `main` inside <article> or <main>, `side` inside menus, page headers,
footers, sidebars, notices, adverts, forms and comments, `hint` inside a main element but under a name that may mean such
a thing or not (`has-sidebar`, `acme-promo-box`), `open` elsewhere. The token stream of a page is its blocks that are not
`main`, in page order. The parsed pages are a table in the shared folder that all later steps read.

A task takes its pages batch by batch. In each, it concatenates the streams of every host, sorts all their suffixes by their
first LEAST tokens (prefix doubling), and gets a row for each run of neighbours with a common prefix of that length: host,
hash of the prefix, least and greatest stream. That is as deep as the array has to go, since any longer repeat is a union of
repeats of LEAST tokens. Runs of all batches meet by (host, prefix), with partial sums before the shuffle, so neither a host
nor a passage with a third of all pages gathers anywhere. Runs that come from distinct streams are the host's boilerplate:
tokens that they cover are removed and unique runs stay. Pages with equal streams count once, so a copy of a page does not
make it boilerplate.

Repeats alone cannot give the text asked for: an article printed on two pages of a host repeats and must stay, and an advert
shown once is unique and must go. So structure decides these two: blocks of a main element stay as they are, and unique
runs inside `side` blocks go. Pages with a main element consist of its blocks and of the unique runs of its hint blocks;
pages without one, of the unique runs of their open blocks.

Structure: an element is `side` by its tag, its role attribute, or a class or id of which one word is in SIDE_WORDS and each
other one is too, or says what kind of box or whose it is (`cookie-bar`, `site-footer`, `post-comments-list`). With any other
word beside a side word (`has-sidebar`, `related-work`) the name leaves it open, and the host's repeats decide. A menu, footer or sidebar by tag holds no main element. A form, or a wrapper that is named so, does not
decide about an <article> or <main> inside it unless the page has one elsewhere.

Defined cases: null html and pages with nothing left have empty text. A page without url belongs to the host "". Rows that
repeat a page_id each get a row and count as one stream if they are equal. A tag that the page's end cuts off is dropped. An attribute's quotes count where they follow `=` and
close before white space, a slash or the tag's end; others are letters, so that a tag with a quote too many ends at its `>`. Character references cut off stay as text. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import new_folder, table

LEAST = 6
#: Tokens of the streams that one suffix array is made of, at least (a batch of pages goes on to its end).
ARRAY_TOKENS = 500_000
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:=\s*+(?:\"[^\"]*\"|'[^']*')(?=[\s/>]|\Z)|[^>])*+)(?:>|\Z)", re.S)
_NAMED = re.compile(r"(?<![\w:.-])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
#: HTML element names by what they mean here.
MAIN = {"article", "main"}
SIDE = {"nav", "footer", "aside", "menu", "dialog", "button"}
SOFT = {"form", "fieldset"}
SKIPPED = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "object", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr", "br"}
ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "form", "dialog", "alertdialog", "menu", "menubar", "toolbar"}
SIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "masthead", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "newsletter", "subscribe", "share", "sharing", "social", "related", "comment", "comments", "respond", "disqus", "search", "skip", "pagination", "pager", "toolbar", "widget", "adsbygoogle"}
#: What a side word may be joined with: kinds of boxes after it, and whose it is before it.
BOXES = {"area", "bar", "block", "body", "box", "button", "buttons", "container", "content", "form", "header", "icons", "inner", "item", "left", "link", "links", "list", "message", "overlay", "panel", "posts", "articles", "right", "row", "section", "signup", "slot", "thread", "title", "toggle", "top", "unit", "wrap", "wrapper"}
OWNERS = {"article", "blog", "bottom", "entry", "footer", "global", "header", "left", "main", "page", "post", "primary", "reader", "right", "secondary", "site", "top", "user"}
#: Roles of what lies in a main element.
IN_MAIN = ("main", "maybe", "hint", "maybe hint")
#: Names by which an <article> or <main> itself is no main element.
NOT_MAIN = {"comment", "comments", "ad", "ads", "advert", "advertisement", "sponsored", "promo", "related"}


def _words_of(name: str) -> list[str]:
    """The words of a class or id: between hyphens and underscores, and at capitals inside it."""
    return [p.lower() for p in re.split(r"[-_]+|(?<=[a-z0-9])(?=[A-Z])", name) if p]


def _is_side(name: str) -> bool:
    """Whether a class or id names something beside the article: a side word, and nothing but what such words are joined with."""
    parts = _words_of(name)
    return any(p in SIDE_WORDS for p in parts) and all(p in SIDE_WORDS or p in BOXES or p in OWNERS for p in parts)


def _hints(name: str) -> bool:
    """Whether it has a side word among others that leave open what it names."""
    return not _is_side(name) and any(p in SIDE_WORDS for p in _words_of(name))


def _role_of(name: str, attributes: str, above: str) -> str:
    """The role of an element inside one of role `above`. `soft` is side but for main elements, `maybe` such a main element; `hint` and `maybe hint` lie in main elements, by a name that leaves open whether they are side."""
    named: dict[str, list[str]] = {}
    for attribute, value in _NAMED.findall(attributes):
        named.setdefault(attribute.lower(), value.strip("\"'").split())
    names = named.get("class", []) + named.get("id", [])
    if name in MAIN:
        if above == "side" or any(n.lower() in NOT_MAIN for n in names):
            return "side"
        return "maybe" if above == "soft" else above if above in IN_MAIN else "main"
    if name in SIDE or (name == "header" and above not in IN_MAIN):
        return "side"
    if name in SOFT or name not in ("html", "body") and (any(map(_is_side, names)) or any(r.lower() in ROLES for r in named.get("role", []))):
        return "side" if above in IN_MAIN or above == "side" else "soft"
    if above in ("main", "maybe") and any(map(_hints, names)):
        return "hint" if above == "main" else "maybe hint"
    return above


def blocks(page: str | None) -> list[tuple[str, str]]:
    """(role, text) of each block with text, in page order; roles are main, hint, side and open."""
    found = list(_blocks(page or ""))
    elsewhere = any(r in ("main", "hint") for r, _ in found)
    plain = {"maybe": "side" if elsewhere else "main", "maybe hint": "side" if elsewhere else "hint", "soft": "side"}
    return [(plain.get(r, r), t) for r, t in found]


def _blocks(page: str) -> Iterator[tuple[str, str]]:
    stack: list[tuple[str, str]] = [("", "open")]
    buffer: list[str] = []
    at = 0

    def flush() -> Iterator[tuple[str, str]]:
        text = " ".join(html.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            yield stack[-1][1], text

    while at < len(page):
        tag = _TAG.search(page, at)
        buffer.append(page[at : tag.start() if tag else len(page)])
        if not tag:
            break
        at = tag.end()
        closing, name = tag[1], (tag[2] or "").lower()
        if not name:
            continue
        if name in SKIPPED:
            if not closing and not tag[3].rstrip().endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name == "br":
            buffer.append(" ")
            continue
        if name not in INLINE:
            yield from flush()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    if stack[k - 1][1] != stack[-1][1]:
                        yield from flush()
                    del stack[k:]
                    break
            continue
        if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") or name not in INLINE and name not in VOID and stack[-1][0] == "p":
            ends = {"p"} if name not in ("li", "tr", "td", "th", "dt", "dd", "option") else {name, "p"} | ({"td", "th"} if name in ("tr", "td", "th") else set()) | ({"dt", "dd"} if name in ("dt", "dd") else set())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    del stack[k:]
                    break
                if stack[k][0] not in INLINE:
                    break
        if name in VOID or tag[3].rstrip().endswith("/"):
            continue
        above = stack[-1][1]
        role = _role_of(name, tag[3], above)
        if role != above:
            yield from flush()
        stack.append((name, role))
    yield from flush()


def host_of(url: str | None) -> str:
    found = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def parsed_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, key, host, text, stream, roles, blocks), kept in the shared folder.

    text is null where repeats decide: pages without a main element, and those with `hint` blocks in it, whose other blocks keep
    their role (`side` outside the main element). stream is the hash of all blocks; key tells rows of one page_id apart.
    """
    spark = pages.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, texts, streams, roles, others = [], [], [], [], []
            for page, url in zip(batch.column(0), batch.column(2), strict=True):
                parts = blocks(page.as_py())
                main = [t for r, t in parts if r == "main"]
                hinted = any(r == "hint" for r, _ in parts)
                rest = [("side" if hinted and r == "open" else r, t) for r, t in parts if hinted or r != "main"]
                hosts.append(host_of(url.as_py()))
                texts.append("\n".join(main) if main and not hinted else None)
                roles.append([r for r, _ in rest])
                others.append([t for _, t in rest])
                streams.append(xxhash.xxh64_intdigest("\n".join(f"{r} {t}" for r, t in parts)))
            made = [pa.array(hosts, pa.string()), pa.array(texts, pa.string()), pa.array(np.array(streams, np.uint64).view(np.int64)), pa.array(roles, pa.list_(pa.string())), pa.array(others, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], ["page_id", "url", "key", "host", "text", "stream", "roles", "blocks"])

    words = T.ArrayType(T.StringType())
    schema = T.StructType([pages.schema["page_id"], *(T.StructField(n, k) for n, k in (("url", T.StringType()), ("key", T.LongType()), ("host", T.StringType()), ("text", T.StringType()), ("stream", T.LongType()), ("roles", words), ("blocks", words)))])
    path = new_folder(spark, "parsed")
    pages.select(F.col("html").cast("string"), "page_id", F.col("url").cast("string"), F.xxhash64("html").alias("key")).mapInArrow(run, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def _stream(roles: list[str], texts: list[str]) -> list[str]:
    """The tokens of a page's blocks that may be boilerplate."""
    return [w for r, t in zip(roles, texts, strict=True) if r != "main" for w in t.split(" ")]


def _hash(words: list[str]) -> int:
    return xxhash.xxh64_intdigest(" ".join(words))


def suffix_runs(hosts: list[int], streams: list[list[str]], least: int) -> list[np.ndarray]:
    """The suffixes of all streams that have `least` tokens, sorted by host and their first `least` tokens: the places in the
    concatenation of the streams, cut into runs of suffixes of one host that share these tokens.
    """
    number: dict[str, int] = {}
    token = np.fromiter((number.setdefault(w, len(number)) for s in streams for w in s), np.int64)
    lengths = np.array([len(s) for s in streams], np.int64)
    left = np.concatenate([np.arange(n, 0, -1) for n in lengths.tolist()]) if len(token) else token  # tokens up to the stream's end
    starts = np.flatnonzero(left >= least)
    if not len(starts):
        return []

    def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max(initial=0)) + 2) + b + 1, return_inverse=True)[1]

    def ahead(rank: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([rank[by:], np.full(min(by, len(rank)), -1, np.int64)])

    rank, depth = np.unique(token, return_inverse=True)[1], 1
    while 2 * depth <= least:
        rank, depth = paired(rank, ahead(rank, depth)), 2 * depth
    if depth < least:
        rank = paired(rank, ahead(rank, least - depth))
    host = np.repeat(np.array(hosts, np.int64), lengths)
    rank = paired(host[starts], rank[starts])
    order = np.argsort(rank, kind="stable")
    return np.split(starts[order], np.flatnonzero(np.diff(rank[order])) + 1)


def boilerplate(parsed: DataFrame, least: int = LEAST) -> DataFrame:
    """(host, prefix): hash of each `least` tokens that stand in distinct streams of a host."""

    def rows(hosts: list[str], ids: list[int], streams: list[list[str]]) -> pa.RecordBatch:
        known: dict[str, int] = {}
        runs = suffix_runs([known.setdefault(h, len(known)) for h in hosts], streams, least)
        ends = np.cumsum([len(s) for s in streams])
        flat = [w for s in streams for w in s]
        first = np.fromiter((r[0] for r in runs), np.int64, len(runs))
        of = np.searchsorted(ends, np.concatenate(runs), "right") if runs else first
        cuts = np.cumsum([0, *map(len, runs)])[:-1].astype(np.int64)
        stream = np.array(ids, np.int64)[of]
        least_of, most_of = (f.reduceat(stream, cuts) for f in (np.minimum, np.maximum)) if runs else (first, first)
        heads = np.fromiter((_hash(flat[i : i + least]) for i in first.tolist()), np.uint64, len(runs)).view(np.int64)
        names = [hosts[k] for k in np.searchsorted(ends, first, "right").tolist()]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(heads), pa.array(least_of), pa.array(most_of)], ["host", "prefix", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts, ids, streams, held = [], [], [], 0
        for batch in batches:
            for host, stream, roles, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                hosts.append(host)
                ids.append(stream)
                streams.append(_stream(roles.as_py(), parts.as_py()))
                held += len(streams[-1])
                if held >= ARRAY_TOKENS:
                    yield rows(hosts, ids, streams)
                    hosts, ids, streams, held = [], [], [], 0
        if streams:
            yield rows(hosts, ids, streams)

    runs = parsed.select("host", "stream", "roles", "blocks").mapInArrow(run, "host string, prefix long, a long, b long")
    return runs.groupBy("host", "prefix").agg(F.min("a").alias("a"), F.max("b").alias("b")).where(F.col("a") != F.col("b")).select("host", "prefix")


def unique_runs(parsed: DataFrame, repeated: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, key, text) of pages that repeats decide: their main blocks, and what is left of open and hint blocks."""
    id_type = parsed.schema["page_id"]

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for roles, parts in zip(batch.column(3), batch.column(4), strict=True):
                words = _stream(roles.as_py(), parts.as_py())
                keys = [_hash(words[i : i + least]) for i in range(len(words) - least + 1)]
                out.append(np.array(keys, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.list_(pa.int64()))], ["page_id", "key", "host", "prefixes"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for roles, texts, starts in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                parts = [t.split(" ") for t in texts]
                step = np.zeros(sum(map(len, parts)) + least + 1, np.int64)
                np.add.at(step, starts or [], 1)
                np.add.at(step, [s + least for s in starts or []], -1)
                covered, at, kept = (np.cumsum(step) > 0).tolist(), 0, []
                for role, words in zip(roles, parts, strict=True):
                    if role == "main":
                        kept.append(" ".join(words))
                        continue
                    if role in ("open", "hint"):
                        kept.append(" ".join(w for k, w in enumerate(words) if not covered[at + k]))
                    at += len(words)
                out.append("\n".join(k for k in kept if k))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "key", "text"])

    bare = parsed.where(F.col("text").isNull())
    long = T.LongType()
    schema = T.StructType([id_type, T.StructField("key", long), T.StructField("host", T.StringType()), T.StructField("prefixes", T.ArrayType(long))])
    starts = bare.select("page_id", "key", "host", "roles", "blocks").mapInArrow(heads, schema).select("page_id", "key", "host", F.posexplode("prefixes").alias("start", "prefix"))
    covers = starts.join(repeated, ["host", "prefix"], "left_semi").groupBy("page_id", "key").agg(F.sort_array(F.collect_set("start")).alias("starts"))
    whole = bare.select("page_id", "key", "roles", "blocks").dropDuplicates(["page_id", "key"])
    both = whole.alias("w").join(covers.alias("c"), F.col("w.page_id").eqNullSafe(F.col("c.page_id")) & (F.col("w.key") == F.col("c.key")), "left").select("w.page_id", "w.key", "roles", "blocks", "starts")
    return both.mapInArrow(cut, T.StructType([id_type, T.StructField("key", long), T.StructField("text", T.StringType())]))


def main_text(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, text; a row for each row of pages."""
    parsed = parsed_pages(pages)
    runs = unique_runs(parsed, boilerplate(parsed, least), least)
    bare = parsed.where(F.col("text").isNull()).select("page_id", "url", "key").alias("p")
    bare = bare.join(runs.alias("r"), F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("p.key") == F.col("r.key")), "left")
    bare = bare.select("p.page_id", "p.url", F.coalesce("r.text", F.lit("")).alias("text"))
    return parsed.where(F.col("text").isNotNull()).select("page_id", "url", "text").unionByName(bare)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
