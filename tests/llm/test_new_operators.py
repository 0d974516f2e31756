"""The Merkle manifest, ranked search and the quality classifier against plain code."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import same
from pyspark.sql import functions as F

from helixframe.llm import line_quality, merkle, quality_classifier, ranked_search

ODD = [
    (1, "Hello there, this line is long enough\nshort\n", "en", "a"), (2, "hello THERE, this line\nis long enough ", "en", "a"), (3, None, None, None), (4, "", "en", "a"), (5, " \n\t ", None, "é"),
    (6, "12345 !!", "en", "b"), (7, "Ein sehr langer Satz über nichts \n" * 20_000, "de", "a"), (9, "Ein Satz über nichts", "de", "b"), (9, "Ein Satz über nichts", "de", "b"), (9, "another text", "de", "b"),
    (None, "Hello there", "en", None), (11, "word " * 50_000, "en", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(d, t, lang, s, len(t or ""), "x", 1, 2) for d, t, lang, s in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, path string, rank int, tree int")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# manifest


def plain_leaf(doc_id, text, lang, source, n_chars):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest(*map(part, (doc_id, source, lang, n_chars, text)))


def plain_tree(leaves):
    """The levels of a tree, leaves first."""
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def plain_path(tree, at):
    out = []
    for level in tree[:-1]:
        run = at - at % 3
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + 3])))
        at //= 3
    return out


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, path) of every row (doc_id, text, lang, source, n_chars)."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append((r[0], plain_leaf(*r)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [plain_tree([leaf for _, leaf in sorted(by_source[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for s in order]
    top = plain_tree([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(order):
        for at, (doc, leaf) in enumerate(sorted(by_source[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            out.append((doc, leaf, trees[k][-1][0], top[-1][0], plain_path(trees[k], at) + plain_path(top, k)))
    return out


def key(rows):
    return sorted(rows, key=repr)


def made_rows(docs, height):
    got = merkle.proofs(merkle.manifest(docs, height=height)).collect()
    return key([(r["doc_id"], r["leaf"], r["subroot"], r["root"], [(s["left"], s["right"]) for s in r["path"]]) for r in got])


def test_proofs_of_odd_rows_are_those_of_plain_trees(odd):
    rows = [(d, t, lang, s, len(t or "")) for d, t, lang, s in ODD]
    for levels in (1, 5):
        assert made_rows(odd, levels) == key(plain_manifest(rows))


@pytest.mark.parametrize("n", [1, 2, 28, 100])
def test_tiers_of_blocks_give_the_same_tree_at_every_size(spark, n):
    rows = [(i * 7 % n, f"text {i}\n", "en", "one" if i % 5 else "two", 6) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert made_rows(docs, 2) == key(plain_manifest(rows))


def test_a_log_is_in_postorder_and_places_find_every_node():
    for n in [*range(1, 90), 243, 244, 728]:
        leaves = [digest(str(i)) for i in range(n)]
        tree = plain_tree(leaves)
        log = merkle.append_nodes(leaves, merkle.levels(n))
        assert len(log) == sum(map(len, tree)) and log[-1] == tree[-1][0]
        for level, nodes in enumerate(tree):
            at = merkle.places(level, np.arange(len(nodes)), n, len(tree) - 1)
            assert [log[k] for k in at] == nodes
            if level:  # a parent comes after its last child and all of the child's other siblings
                below = merkle.places(level - 1, np.minimum(np.arange(len(nodes)) * 3 + 2, len(tree[level - 1]) - 1), n, len(tree) - 1)
                assert (at == below + 1).all()


def test_log_table_holds_every_node_once(spark, sf):
    made = merkle.manifest(spark.read.parquet(f"{sf}/documents.parquet"))
    got = merkle.log_nodes(made).groupBy("tree").agg(F.count("*").alias("nodes"), F.count_distinct("node").alias("different")).collect()
    n = {r["tree"]: r["n"] for r in made.sources.collect()}
    assert {r["tree"]: r["nodes"] for r in got} == {t: sum(-(-k // 3**j) for j in range(merkle.levels(k) + 1)) for t, k in n.items()}


def test_tampering_is_found_by_the_fold(odd):
    claim = merkle.leaf(text=F.concat(F.col("text"), F.lit(".")))
    got = merkle.proofs(merkle.manifest(odd, F.when(F.col("doc_id") > 5, claim)))
    for r in got.withColumn("to", merkle.folded(F.coalesce("claim", "leaf"), F.col("path"))).collect():
        assert (r["to"] == r["root"]) == (r["doc_id"] is None or r["doc_id"] <= 5)


def test_merkle_query_equals_sql(spark, sf):
    same(merkle.op13_merkle(spark, sf), sf, merkle.SQL)


def test_manifest_of_an_empty_table(odd):
    made = merkle.manifest(odd.limit(0))
    assert made.root is None and merkle.proofs(made).count() == 0


# search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_search(docs, items, best):
    counts = [(d, Counter(WORD.findall(fold(t)))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counts:
            m = 50 + (50 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(WORD.findall(fold(text))) if t in c)
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:best])]
    return key(out)


def found(docs, items, **more):
    return key(tuple(r) for r in ranked_search.search(docs, items, **more).select("item_id", "rank", "doc_id", "score").collect())


ITEMS = [(1, "hello THERE line"), (2, "nichts über Satz nichts"), (3, "word"), (4, None), (5, ""), (6, "nowhere-at-all"), (7, "12345 text another"), (None, "enough short")]


def test_search_of_odd_rows(spark, odd, monkeypatch):
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in ITEMS], "item_id long, text string, q string, block int")
    docs = [(d, t) for d, t, _, _ in ODD]
    for best in (1, 3, 50):
        assert found(odd, items, best=best) == plain_search(docs, ITEMS, best)
    assert found(odd.limit(0), items) == [] and found(odd, items.limit(0)) == []
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 200)
    assert ranked_search._blocks(items)[1] > 1 and found(odd, items) == plain_search(docs, ITEMS, 50)


def test_ties_and_small_parts_are_searched_whole(spark, monkeypatch):
    rows = [(i, ["red green blue", "red red", "green blue " * 3, "other words here", "red"][i % 5]) for i in range(300, 0, -1)]
    items = [(1, "red"), (2, "green blue"), (3, "red other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(ranked_search, "PART_DOCS", 7)
    monkeypatch.setattr(ranked_search, "AT_ONCE", 10)
    for seeds in (1, 4):
        got = found(docs, spark.createDataFrame(items, "item_id long, text string"), seeds=seeds)
        assert got == plain_search(rows, items, 50) and len(got) == 150


def test_search_query_equals_sql(spark, sf):
    same(ranked_search.op12_ranked_search(spark, sf), sf, ranked_search.SQL)


# quality


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.op11_quality_classifier(spark, sf).collect()
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert sum(a for a, b in held if b) / sum(b for _, b in held) > 0.97
    changed = labels.withColumn("quality", F.when(quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_classifier.classify(docs, quality_classifier.fit(docs, changed)).collect()
    assert {(r["doc_id"], r["score"]) for r in again} == {(r["doc_id"], r["score"]) for r in got}


def test_marginals_equal_sums_over_all_labellings():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5):
        scores, move = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
        total, good = 0.0, np.zeros(n)
        for labels in itertools.product((0, 1), repeat=n):
            p = math.exp(sum(scores[k, v] for k, v in enumerate(labels)) + sum(move[a, b] for a, b in itertools.pairwise(labels)))
            total += p
            good += p * np.array(labels)
        assert np.allclose(quality_classifier._long(scores, move), good / total)
        assert np.allclose(quality_classifier.good_lines(scores, np.array([n]), move), good / total)


def test_texts_are_scored_alike_alone_and_together():
    rng = np.random.default_rng(4)
    counts = np.array([3, 1, 200, 0, 64, 65])
    scores, move = rng.normal(size=(counts.sum(), 2)) * 3, rng.normal(size=(2, 2))
    ends = np.cumsum(counts)
    alone = [quality_classifier._long(scores[e - c : e], move) for e, c in zip(ends, counts, strict=True) if c]
    assert np.allclose(quality_classifier.good_lines(scores, counts, move), np.concatenate(alone))
    weight = rng.normal(size=(6, 2))
    features = rng.normal(size=(counts.sum(), 2))
    before, after = quality_classifier._neighbours(features, counts)
    assert np.allclose(quality_classifier._evidence(features, counts, weight), np.hstack([features, before, after]) @ weight)
    assert not before[0].any() and not before[3].any() and not after[2].any() and (before[1] == features[0]).all()


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (2, 0, "c"), (6, 0, "d"), (11, 0, "e"), (None, 1, "f"), (7, None, "g")], "doc_id long, quality int, text string")
    model = quality_classifier.fit(odd, labels)
    got = quality_classifier.classify(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert [r["n_lines"] for r in got if r["doc_id"] == 7] == [20_001]
    constant = quality_classifier.classify(odd, quality_classifier.fit(odd, labels.limit(0))).collect()
    assert all(r["score"] == 0.5 and r["predicted"] == 1 for r in constant)
    one = quality_classifier.classify(odd, quality_classifier.fit(odd, labels.where("quality = 0 AND doc_id IN (6, 11)"))).collect()
    assert len({r["score"] for r in one}) == 1 and one[0]["predicted"] == (one[0]["score"] >= 0.3)
    assert quality_classifier.classify(odd.limit(0), model).count() == 0


def test_training_uses_all_lines_of_the_sample(spark, monkeypatch):
    text = "\n".join(f"line number {i} of a long text" for i in range(1000))
    docs = spark.createDataFrame([(1, text), (2, "one line")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    features, words, chars, counts, y = line_quality.labelled_lines(docs, labels)
    assert counts.tolist() == [1000, 1] and y.tolist() == [1, 0] and len(features) == len(words) == len(chars) == 1001
    assert chars.tolist() == [len(x) for x in text.split("\n")] + [8]
    some = line_quality.labelled_lines(docs, labels, train_chains=5)
    assert len(some[0]) <= 5 * line_quality.TRAIN_LINES


# very long runs


def test_token_ids_of_long_runs_are_those_of_the_whole_text(monkeypatch):
    import tiktoken

    from helixframe.llm import token_matrix

    coder = tiktoken.Encoding("ranks", pat_str=token_matrix.PATTERN, mergeable_ranks=token_matrix.load_ranks(), special_tokens={})
    for blank in (" ", "\n", "\t", "\u00a0", "\u3000", " \n", "\r\n", "\x85 ", "\x1c"):
        run = blank * 12_000
        for text in (run, f"a{run}", f"{run}b", f"a{run}b", f"a {run}1", f"!{run}!{run}", f"{run}'s{run[:50]}x{run}"):
            assert token_matrix.token_ids(coder, text).tolist() == coder.encode(text, disallowed_special=())
    for text in (" " * 10_000_000, "x" + "\n" * 10_000_000 + "y", "a" * 1_000_000):
        assert coder.decode(token_matrix.token_ids(coder, text).tolist()) == text


def test_a_very_long_run_does_not_end_the_query(spark):
    from helixframe.llm import token_matrix

    docs = spark.createDataFrame([(1, "a" + " " * 2_000_000 + "b"), (2, "c")], "doc_id long, text string")
    ranks = token_matrix.load_ranks()
    rows = token_matrix.token_matrix(docs, ranks).collect()
    assert {d for r in rows for d in r["doc_ids"]} == {1, 2}


# pages


def texts_of(spark, pages):
    from helixframe.llm import html_text

    rows = [(k, f"http://h.example/{k}", page) for k, page in enumerate(pages)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(got, key=lambda r: r["page_id"])]


def test_tags_with_odd_quotes_end_where_they_should(spark):
    pages = {
        '<article><p title="x>hello</p><p>Second': "hello\nSecond", "<article><p class=it's>Hello": "Hello", "<article><p title='x>a</p><p id='y'>b": "a\nb",
        '<article><p title="a > b">one</p><p data-x="<p>no</p>" >two</p>': "one\ntwo", '<article><p title = "x>y"/>three': "three", '<article><a href="x"title="y">four</a>': "four",
        '<article><p title="cut': "", "<article><p a=\"b' c='d\">five</p>": "five",
    }
    assert texts_of(spark, list(pages)) == list(pages.values())


def test_side_boxes_with_long_names_go(spark):
    gone = ["adsbygoogle", "post-comments-list", "newsletter-signup-form", "top-nav-menu", "commentList", "site_footer_links", "ad-slot-top"]
    kept = ["content-wrapper", "story", "lead-paragraph"]
    pages = [f'<article><p>Before it</p><div class="{name}">inside the box</div><p>after</p></article>' for name in [*gone, *kept]]
    assert texts_of(spark, pages) == ["Before it\nafter"] * len(gone) + ["Before it\ninside the box\nafter"] * len(kept)


def test_repeats_on_the_host_decide_about_names_that_leave_it_open(spark):
    promo = "buy our very special offer of the week now"
    page = lambda k, inside: f'<nav>home news about</nav><article><p>story {k} begins</p><div class="acme-promo-x">{inside}</div><p>story {k} ends</p></article>'
    own = [" ".join(f"word{k}{w}" for w in range(9)) for k in range(3)]
    got = texts_of(spark, [page(0, promo), page(1, promo), page(2, promo + " or call " + own[2]), page(3, own[0]), page(4, own[1]), page(4, own[1])])
    assert got[:2] == ["story 0 begins\nstory 0 ends", "story 1 begins\nstory 1 ends"]
    assert got[2] == f"story 2 begins\nor call {own[2]}\nstory 2 ends"
    assert got[3] == f"story 3 begins\n{own[0]}\nstory 3 ends" and got[4] == got[5] == f"story 4 begins\n{own[1]}\nstory 4 ends"


def test_archives_begin_with_a_warcinfo_record(spark, tmp_path):
    import glob
    import gzip

    from helixframe.llm import warc

    pages = spark.createDataFrame([(k, f"http://h/{k}", f"<p>{k % 40}</p>" * 20) for k in range(100)], "page_id long, url string, html string").repartition(3)
    warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=2000, date="2024-05-06T07:08:09Z")
    files = glob.glob(str(tmp_path / "w" / "*.gz"))
    found = [list(warc.parse_archive(gzip.open(f))) for f in files]
    assert len(files) > 5 and sum(len(f) - 1 for f in found) == 100
    for records in found:
        kinds = [fields[b"warc-type"] for fields, _ in records]
        assert kinds[0] == b"warcinfo" and b"warcinfo" not in kinds[1:] and b"format: WARC" in records[0][1]
        assert {fields[b"warc-date"] for fields, _ in records} == {b"2024-05-06T07:08:09Z"}
    assert len({fields[b"warc-record-id"] for records in found for fields, _ in records}) == 100 + len(files)
