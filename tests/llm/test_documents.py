"""Operators on documents against SQL or plain code."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from conftest import same
from pyspark.sql import functions as F

from helixframe.llm import common, decontaminate, language_id, line_dedup, line_quality, packing, simhash, token_counts, token_matrix

ODD = [
    (1, "Hello there, this line is long enough\nshort\n", "en"), (2, "hello THERE, this line is long enough ", "en"), (3, "x\n\tHello there, this line is long enough", "en"),
    (4, None, None), (5, "", "en"), (6, " \n\t ", None), (7, "12345 !!", "en"), (8, "Ein sehr langer Satz \U0001d54f über nichts " * 3000, "de"),
    (9, "Ein sehr langer Satz über nichts", "de"), (9, "Ein sehr langer Satz über nichts", "de"), (None, "Hello there, this line is long enough", "en"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, very long and repeated texts, and columns whose names the operators use themselves."""
    rows = [(d, t, lang, "s", len(t or ""), "p", 1) for d, t, lang in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, pos string, row int")


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


# language


def test_language_is_found_in_held_out_documents(spark, sf):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97


def plain_grams(text):
    words = re.findall(r"\w+", "".join(c.lower() if c.isalpha() else " " for c in text))
    return Counter(g for w in words for n in (1, 2, 3) for g in (f" {w} "[i : i + n] for i in range(len(w) + 3 - n)) if g != " ")


def test_language_scores_equal_plain_naive_bayes(spark):
    train = [("the cat and the dog", "en"), ("der hund und die katze", "de"), ("the end", "en")]
    langs, prior, table = language_id.fit(spark.createDataFrame(train, "text string, lang string"), 22)
    bits = {g: b for t in [*train, ("hat hut",)] for g in plain_grams(t[0]) for b in [_bucket(g, 22)]}
    assert len(set(bits.values())) == len(bits)
    counts = {v: sum((plain_grams(t) for t, w in train if w == v), Counter()) for v in langs}
    for text in ("the hut", "hund", "Katze and hat!"):
        want = []
        for v in langs:
            total = sum(counts[v].values()) + language_id.ALPHA * (1 << 22)
            want.append(math.log(sum(w == v for _, w in train) / 3) + sum(n * math.log((counts[v][g] + language_id.ALPHA) / total) for g, n in plain_grams(text).items()))
        p = 1 / sum(math.exp(x - max(want)) for x in want)
        lang, score = language_id.score_texts([text], langs, prior, table)
        assert lang[0] == langs[want.index(max(want))]
        assert score[0] == pytest.approx(p, rel=1e-4)


def _bucket(gram, bits):
    found = [b for _, bucket in language_id.features([gram.strip() or "x"], bits) for b in bucket.tolist()]
    parts = list(plain_order(gram.strip()))
    return dict(zip(parts, found, strict=True))[gram]


def plain_order(word):
    padded = f" {word} "
    for n in (1, 2, 3):
        for i in range(len(padded) + 1 - n):
            if padded[i : i + n] != " ":
                yield padded[i : i + n]


def test_long_text_in_pieces_scores_the_same(monkeypatch):
    text = "the quick brown fox jumps over a lazy dog " * 400
    whole = [np.bincount(b, minlength=1 << 12) for _, b in language_id.features([text], 12)]
    monkeypatch.setattr(language_id, "CHUNK", 100)
    parts = [p for _, group in language_id._pieces([text]) for p in group]
    assert "".join(parts) == text and len(parts) > 100
    cut = [sum(np.bincount(b, minlength=1 << 12) for p in parts for n, (_, b) in enumerate(language_id.features([p], 12)) if n == k) for k in range(3)]
    for a, b in zip(whole, cut, strict=True):
        assert (a == b).all()


def test_any_number_of_labels(spark, monkeypatch):
    """300 labels: blocks of them, one after another, give what one matrix gives."""
    alphabet = [chr(0x4E00 + k) for k in range(900)]
    rows = [(k * 10 + j, "".join(alphabet[3 * k : 3 * k + 3]) * (2 + j), f"l{k:03}") for k in range(300) for j in range(3)]
    docs = spark.createDataFrame(rows + [(9999, "123", "l000"), (10000, None, None)], "doc_id long, text string, lang string")
    whole = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.language_id(docs).collect()}
    monkeypatch.setattr(language_id.fit_blocks, "__defaults__", (language_id.BITS, 500))
    one = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.language_id(docs).collect()}
    assert sum(whole[d][0] == lang for d, _, lang in rows) / len(rows) > 0.9 and whole[9999] == whole[10000] == ("und", 0.0)
    assert all(whole[d][0] == one[d][0] and abs(whole[d][1] - one[d][1]) < 1e-6 for d in one)


def test_language_of_odd_rows(odd, none):
    got = {(r["doc_id"], r["lang_pred"]) for r in language_id.language_id(odd).collect()}
    assert {(4, "und"), (5, "und"), (6, "und"), (7, "und")} <= got
    assert language_id.language_id(odd).count() == len(ODD)
    assert language_id.language_id(none).count() == 0
    kept = language_id.keep_identified(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 8, 9, None}


# lines


def plain_line_dedup(rows, chars=20, docs=3):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    where = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= chars and d is not None:
                where[key(x)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(where[key(x)]) < docs or d == max(where[key(x)])]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_line_dedup_equals_sql(spark, sf):
    same(line_dedup.op8_line_dedup(spark, sf), sf, line_dedup.SQL)


def test_line_dedup_of_odd_rows(odd, none):
    got = line_dedup.dedup_lines(odd).collect()
    mine = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in got), key=repr)
    assert mine == plain_line_dedup([(d, t) for d, t, _ in ODD])
    assert line_dedup.dedup_lines(none).count() == 0
    docs = {r["doc_id"]: r for r in line_dedup.drop_lines(odd).collect()}
    assert docs[1]["text"] == "short\n" and docs[1]["n_chars"] == 6 and docs[1]["pos"] == "p"
    assert docs[4]["text"] is None and docs[3]["text"] == ODD[2][1]
    assert line_dedup.drop_lines(odd).columns == odd.columns


# near duplicates


def plain_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def check_simhash(docs, rows, **more):
    got = sorted(((r[0], r[1], r[2]) for r in simhash.near_duplicates(docs, **more).collect()), key=repr)
    fps = [(d, plain_fingerprint(t)) for d, t in rows]
    comp = plain_components(sorted({f for _, f in fps}), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for d, f in fps:
        if d is not None:
            least[comp[f]] = min(d, least.get(comp[f], d))
    assert got == sorted(((d, f"{f:016x}", least.get(comp[f])) for d, f in fps), key=repr)


def test_simhash_equals_plain_code(spark, sf):
    docs = documents(spark, "/root/testdata/sf0.01")
    check_simhash(docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_simhash_of_odd_rows(odd, none):
    check_simhash(odd, [(d, t) for d, t, _ in ODD], hot=2)
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.near_dedup(odd)
    assert kept.columns == odd.columns
    other = odd.where("doc_id = 1").withColumn("text", F.lit("a text of its own that has nothing to do with the first one of this id"))
    assert {r["text"] for r in simhash.near_dedup(odd.unionByName(other)).where("doc_id = 1").collect()} == {ODD[0][1], other.first()["text"]}
    ids = {r["component_id"] for r in simhash.near_duplicates(odd).collect()}
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(ids)


def test_trie_join_links_what_all_pairs_link():
    rng = random.Random(1)
    for n, spread in ((1, 3), (40, 4), (400, 2), (700, 6), (3000, 1)):
        centre = [rng.getrandbits(64) for _ in range(max(1, n // 50))]
        fps = sorted({rng.choice(centre) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(spread * 3))) & (2**64 - 1) for _ in range(n)})
        half = len(fps) // 2
        bucket = np.array([0] * half + [1] * (len(fps) - half))
        comp = simhash.trie_components(bucket, np.array(fps, np.uint64))
        for lo, hi in ((0, half), (half, len(fps))):
            if n > 1000:
                continue
            want = plain_components(range(lo, hi), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
            first = {}
            for i in range(lo, hi):
                first.setdefault(want[i], i)
            assert [first[want[i]] for i in range(lo, hi)] == comp[lo:hi].tolist()
        used = []
        again = simhash.trie_components(bucket, np.array(fps, np.uint64), used=used)
        a, b = (np.concatenate([x[k] for x in used]) if used else np.zeros(0, int) for k in (0, 1))
        assert (again == comp).all() and all((fps[i] ^ fps[j]).bit_count() <= 4 and bucket[i] == bucket[j] for i, j in zip(a, b, strict=True))
        assert (simhash._union(np.arange(len(fps)), a, b) == comp).all()


def test_hot_buckets_are_dealt_again(spark):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    fps = sorted({centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(8))) for _ in range(300)} | {rng.getrandbits(64) for _ in range(50)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = [(r[0] % 2**64, r[1] % 2**64) for r in simhash.links(df, hot=30).collect()]
    want = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    pairs = {frozenset(p) for p in links}
    got = plain_components(fps, lambda a, b: frozenset((a, b)) in pairs)
    sets = lambda c: {frozenset(k for k in fps if c[k] == v) for v in set(c.values())}
    assert sets(got) == sets(want)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
    got = {r[0]: r[1] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[i] == 100 for i in range(101, 140))


# benchmark passages


def test_decontamination_equals_sql(spark, sf):
    same(decontaminate.op2_decontaminate(spark, sf), sf, decontaminate.SQL)


ITEMS = [(1, "a b c d e f g h i j k l"), (2, "B C"), (3, "q"), (None, "p p p"), (5, None), (6, " .. "), (7, "b c"), (10, "a b c d e f g h i j k l")]
TEXTS = [(1, "x A b c d e f g h i j Z"), (2, "q q"), (3, "p p p p"), (4, None), (5, "b c d e f g h i j k l a"), (6, ""), (7, "a b c d e f g h i"), (7, "c b"), (None, "q é"), (9, "É b\tc é " * 2000)]


def plain_hits(text, items, w=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, ids = split(text), set(), set()
    for item, t in items:
        own = split(t)
        for i in range(max(1, len(own) - w + 1)) if own else ():
            win = own[i : i + w]
            for at in range(len(words) - len(win) + 1):
                if words[at : at + len(win)] == win:
                    hit.update(range(at, at + len(win)))
                    ids |= {str(item)} - {"None"}
    return len(words), len(hit), len(ids), sorted(ids), bool(hit)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_decontamination_of_odd_rows(spark, broadcast_bytes):
    docs = spark.createDataFrame([(d, t, "y", 1) for d, t in TEXTS], "doc_id long, text string, ids string, start int")
    items = spark.createDataFrame([(i, t, "z") for i, t in ITEMS], "item_id long, text string, words string")
    got = sorted((tuple(r) for r in decontaminate.decontaminate(docs, items, broadcast_bytes=broadcast_bytes).collect()), key=repr)
    assert got == sorted(((d, *plain_hits(t, ITEMS)) for d, t in TEXTS), key=repr)
    assert decontaminate.decontaminate(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    clean = decontaminate.keep_clean(docs, items)
    assert clean.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in clean.collect()) == sorted((d, t) for d, t in TEXTS if d is not None and not plain_hits(t, ITEMS)[4]) or clean.count() == sum(not plain_hits(t, ITEMS)[4] for _, t in TEXTS)


def test_decontamination_runs_no_python(spark, sf):
    plan = decontaminate.op2_decontaminate(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExternalRDD" not in plan and "parallelize" not in plan


def test_a_passage_that_most_documents_hold(spark):
    """Many documents, items and windows that share one passage; ids are those of each item that has it."""
    passage = " ".join(f"p{i}" for i in range(40))
    items = [(i, passage + f" own{i} " + " ".join(f"i{i}x{k}" for k in range(12))) for i in range(30)]
    docs = [(i, f"a{i} {passage} b{i}" if i % 3 else f"clean text number {i}") for i in range(300)] + [(999, f"{items[3][1]} and {passage}")]
    got = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(((d, *plain_hits(t, items)) for d, t in docs), key=repr)


# quality


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_base_figures_equal_plain_code(spark, sf):
    docs = documents(spark, sf).select("text").collect()
    for t in [*(r[0] for r in docs), *(t for _, t, _ in ODD), "a b c d e a b c d e", "a a a a a a", "x\x0by z\x85q"]:
        assert line_quality.base_figures(t) == plain_base(t)


def plain_features(text):
    """The features of each line, a line at a time."""
    out, seen = [], set()
    gaps = " \t\n\x0b\x0c\r!\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~"
    for line in (text or "").split("\n"):
        words = line.split()
        n, row = len(words), [1.0] + [0.0] * 13
        if n:
            letters, low = sum(map(len, words)), line.lower()
            alpha = sum(c not in gaps and not c.isspace() for c in line)
            row[2], row[3] = min(n, 100) / 100, sum(map(line.count, "#*$%&|<>")) / n
            row[4], row[5] = (letters - alpha) / letters, sum(c in "0123456789" for c in line) / len(line)
            row[6] = sum(c.lower() != c for c in line) / max(1, alpha)
            row[7], row[8] = min(letters / n, 20) / 20, len(set(words)) / n
            row[9] = sum(u == v for u, v in itertools.pairwise(words)) / n
            row[10], row[11] = line.rstrip()[-1] in ".!?", line in seen
            row[12] = "http" in low or "@" in line or "\xa9" in line or "licen" in low
            row[13] = sum(w[-1] in "!?#*$%&|" for w in words) / n
            seen.add(line)
        else:
            row[1] = 1.0
        out.append((*map(float, row), n))
    return out


def test_features_of_a_batch_equal_plain_code(spark, sf, monkeypatch):
    texts = [r[0] for r in documents(spark, sf).select("text").collect()] + [t for _, t, _ in ODD] + ["", "\n", "a a\na a\n a a ", "http://X", "HTTP @ licence\u2003x", "\u00c9t\u00c9! \xa9 1\x002", "x\u3000y\x85z"]
    for chunk in (50, 1_000_000):
        monkeypatch.setattr(line_quality, "CHUNK", chunk)
        features, n_words, counts = line_quality.batch_features(texts)
        want = [row for t in texts for row in plain_features(t)]
        assert counts.tolist() == [len((t or "").split("\n")) for t in texts]
        assert n_words.tolist() == [w[-1] for w in want]
        assert np.allclose(features, np.array([w[:-1] for w in want]))


def test_quality_verdict_on_labels_that_were_not_learned_from(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = {r["doc_id"]: r for r in line_quality.line_quality(docs, line_quality.fit(docs, labels.where(~held))).collect()}
    rows = labels.where(held).collect()
    good = [got[r["doc_id"]] for r in rows if r["quality"] == 1 and not got[r["doc_id"]]["base_failed"]]
    bad = [got[r["doc_id"]] for r in rows if r["quality"] == 0]
    assert len(good) > 80 and len(bad) > 10
    assert sum(r["kept"] for r in good) / len(good) > 0.98
    assert sum(not r["kept"] for r in bad) / len(bad) > 0.8
    assert sum(0 < r["content_share"] < 1 for r in got.values()) > 20  # documents with lines of both kinds


def test_lines_of_both_kinds_are_told_apart_from_document_labels_only():
    """Documents whose lines change kind inside; only the kind of most words is known."""
    rng = random.Random(12)
    words = lambda n: " ".join(rng.choice(["river", "stone", "green", "walks", "under"]) + rng.choice("abcde") for _ in range(n)) + "."
    loud = lambda n: " ".join(rng.choice(["BUY", "NOW", "FREE"]) + rng.choice("ABC") + "!!" for _ in range(n))

    def document():
        kinds = []
        while len(kinds) < 12:
            kinds += [rng.random() < 0.5] * rng.randrange(1, 6)
        return [(k, (words if k else loud)(8)) for k in kinds]

    made = [document() for _ in range(200)]
    texts = ["\n".join(t for _, t in d) for d in made]
    features, n_words, counts = line_quality.batch_features(texts[:150])
    labels = np.array([sum(k for k, _ in d) * 2 >= len(d) for d in made[:150]], np.int64)
    field = line_quality.train(features, n_words, counts, labels)
    label, _, _ = line_quality.line_labels(texts[150:], field)
    want = np.array([k for d in made[150:] for k, _ in d])
    assert (label == want).mean() > 0.97
    assert field[1][0, 0] + field[1][1, 1] > field[1][0, 1] + field[1][1, 0]


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    for n in range(1, 8):
        scores, move = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
        value = lambda p: sum(scores[i, v] for i, v in enumerate(p)) + sum(move[a, b] for a, b in itertools.pairwise(p))
        best = max(itertools.product((0, 1), repeat=n), key=value)
        assert tuple(line_quality.viterbi(scores, move).tolist()) == best


def test_texts_decoded_together_equal_one_at_a_time():
    rng = np.random.default_rng(4)
    counts = np.array([1, 3, 0, 200, 64, 65, 2, 1])
    scores, move = rng.normal(size=(counts.sum(), 2)), rng.normal(size=(2, 2))
    parts = np.split(scores, np.cumsum(counts)[:-1])
    assert line_quality.decode(scores, counts, move).tolist() == [v for p in parts if len(p) for v in line_quality.viterbi(p, move).tolist()]


def test_training_follows_the_likelihood():
    """Marginals equal those of all paths, and the gradient of the likelihood that the steps follow is zero at their end."""
    rng = np.random.default_rng(5)
    counts = np.array([1, 4, 2, 5, 3])
    e, move = rng.normal(size=(counts.sum(), 2)), rng.normal(size=(2, 2))
    starts = np.cumsum(counts) - counts
    chains = line_quality._Chains(starts, counts)
    seq = np.empty(len(e), np.int64)
    seq[np.concatenate(chains.at)] = np.concatenate([np.arange(len(a)) for a in chains.at])
    node, pair = line_quality._marginals(e, move, chains, seq)
    want, moves = np.zeros_like(e), np.zeros((2, 2))
    for s, n in zip(starts, counts, strict=True):
        paths = list(itertools.product((0, 1), repeat=int(n)))
        weight = np.array([math.exp(sum(e[s + i, v] for i, v in enumerate(p)) + sum(move[a, b] for a, b in itertools.pairwise(p))) for p in paths])
        for p, w in zip(paths, weight / weight.sum(), strict=True):
            for i, v in enumerate(p):
                want[s + i, v] += w
            for a, b in itertools.pairwise(p):
                moves[a, b] += w
    assert np.allclose(node, want) and np.allclose(pair, moves)


def test_labels_that_a_document_must_keep():
    content, words, document = np.array([0.9, 0.2, 0.1, 0.9, 0.8, 0.1, 0.4]), np.array([1, 5, 4, 6, 3, 1, 9]), np.array([0, 0, 0, 1, 1, 1, 2])
    got = line_quality._constrained(content, words, document, np.array([1, 0, 0]))
    assert got.tolist() == [1, 1, 0, 0, 0, 0, 0]


def test_quality_of_odd_rows(odd, none, spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (8, 0), (None, 1), (7, None)], "doc_id long, quality int")
    field = line_quality.fit(odd, labels)
    clashing = [c for n in ("id", "y", "d", "t", "features", "words") for c in [F.lit(n).alias(n)]]
    again = line_quality.fit(odd.select("*", *clashing), labels.select("*", *clashing))
    assert np.allclose(field[0], again[0]) and np.allclose(field[1], again[1])
    got = line_quality.line_quality(odd.select("*", *clashing), field)
    assert got.count() == len(ODD)
    assert not got.where("doc_id = 4").first()["kept"]
    assert line_quality.line_quality(none, line_quality.fit(none, labels.limit(0))).count() == 0


# tokens


def plain_tokens(word, scores):
    """(tokens, pieces) of the best segmentation, over all places where a piece may begin."""
    text = "▁" + word
    best = [(0.0, 0, ())] + [None] * len(text)
    for j in range(1, len(text) + 1):
        n = len(text[j - 1].encode())
        options = [(best[j - 1][0] + n * scores[""], best[j - 1][1] + n, (*best[j - 1][2], *[""] * n))]
        options += [(best[i][0] + scores[text[i:j]], best[i][1] + 1, (*best[i][2], text[i:j])) for i in range(j - 1, -1, -1) if text[i:j] in scores]
        best[j] = max(options, key=lambda o: (o[0], -o[1]))
    return best[-1][1], best[-1][2]


def test_token_counts_equal_plain_viterbi(spark, sf):
    pieces = token_counts.load_pieces()
    docs = documents(spark, sf).limit(40)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    scores = token_counts.fit(docs, pieces)
    words = Counter(w for t in texts.values() for w in t.split())
    fewest = token_counts.alike(pieces)
    want = Counter()
    for w, n in words.items():
        tokens, cut = plain_tokens(w, fewest)
        assert tokens == len(cut)
        for p in cut:
            want[p] += n
    got = {r["piece"]: r["n"] for r in token_counts.piece_counts(docs, pieces).collect()}
    assert sum(got.values()) == sum(want.values()) and set(got) <= {*pieces, ""}
    total = sum(got.values()) + 0.5 * (len(pieces) + 256)
    assert all(math.isclose(scores[p], math.log((got.get(p, 0) + 0.5) / total)) for p in pieces[:2000])
    assert math.isclose(sum(math.exp(scores[p]) for p in pieces) + 256 * math.exp(scores[""]), 1.0)
    memo = {w: plain_tokens(w, scores)[0] for w in words}
    for r in token_counts.token_counts(docs, scores).collect():
        assert (r["n_words"], r["n_tokens"]) == (len(texts[r["doc_id"]].split()), sum(memo[w] for w in texts[r["doc_id"]].split()))


def test_token_counts_of_odd_rows(odd, none, monkeypatch):
    scores = {"▁a": -1.0, "b": -2.0, "ab": -2.5, "▁": -3.0, "": -13.0}
    words = ["ab", "abab", "aab", "", "é", "\U0001d54f", "b" * 100]
    assert token_counts.count_words(words, scores) == {w: plain_tokens(w, scores)[0] for w in words}
    for word, tokens, back in token_counts.segment_words(words, scores, token_counts.reversed_trie(scores)):
        cut = token_counts.pieces_of(word, back)[::-1]
        assert len(cut) == tokens and sum(scores[p] for p in cut) == pytest.approx(sum(scores[p] for p in plain_tokens(word, scores)[1]))
    whole = sorted(map(tuple, token_counts.token_counts(odd, scores).collect()), key=repr)
    assert len(whole) == len(ODD) and all(r[2] == 0 for r in whole if r[0] in (4, 5, 6))
    for words_kept, chars in ((1, 64), (300_000, 3), (5, 2)):
        monkeypatch.setattr(token_counts, "CACHE_WORDS", words_kept)
        monkeypatch.setattr(token_counts, "CACHE_CHARS", chars)
        assert sorted(map(tuple, token_counts.token_counts(odd, scores).collect()), key=repr) == whole
    assert token_counts.token_counts(none, scores).count() == 0
    empty = token_counts.fit(none, ["a", "b"])
    assert empty["a"] == empty["b"] == empty[""]


def unpack(rows, row):
    texts = defaultdict(dict)
    for r in rows:
        ids, places = np.frombuffer(r["input_ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2")
        assert len(ids) == len(places) == row and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] <= row
        for doc, offset, a, b in zip(r["doc_ids"], r["offsets"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False):
            assert (places[a:b] == np.arange(b - a)).all()
            texts[doc][offset] = ids[a:b]
        assert (ids[r["n_tokens"] :] == 50_256).all()
    return {d: np.concatenate([p[o] for o in sorted(p)]) for d, p in texts.items()}


def test_token_matrix_round_trip(spark, sf):
    import tiktoken

    ranks = token_matrix.load_ranks()
    docs = documents(spark, sf).select("doc_id", "text")
    rows = token_matrix.token_matrix(docs, ranks, row=256, group_tokens=20_000).collect()
    coder = tiktoken.Encoding("t", pat_str=token_matrix.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = unpack(rows, 256)
    for r in docs.collect():
        assert got[r["doc_id"]][-1] == 50_256
        assert coder.decode(got[r["doc_id"]][:-1].tolist()) == r["text"]
    assert len({r["pack_id"] for r in rows}) == len(rows)
    assert sum(r["n_tokens"] for r in rows) / (256 * len(rows)) > 0.95


def test_token_matrix_is_written_and_read_back(spark, sf):
    import tiktoken

    ranks = token_matrix.load_ranks()
    coder = tiktoken.Encoding("t", pat_str=token_matrix.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = unpack(token_matrix.op4_token_matrix(spark, sf).collect(), token_matrix.ROW)
    docs = documents(spark, sf).collect()
    assert len(got) == len(docs) and all(coder.decode(got[r["doc_id"]][:-1].tolist()) == r["text"] for r in docs)


def test_token_matrix_of_odd_rows(odd, none, tmp_path):
    ranks = token_matrix.load_ranks()
    got = token_matrix.token_matrix(odd, ranks).collect()
    assert Counter(d for r in got for d, o in zip(r["doc_ids"], r["offsets"], strict=True) if o == 0) == Counter(d for d, _, _ in ODD)
    assert token_matrix.token_matrix(none, ranks).count() == 0
    named = odd.where("doc_id IS NOT NULL").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"), "text")
    path = str(tmp_path / "m")
    token_matrix.write_matrix(token_matrix.token_matrix(named, ranks), path)
    assert {d for r in odd.sparkSession.read.parquet(path).collect() for d in r["doc_ids"]} == {f"d{d}" for d, _, _ in ODD if d is not None}


def test_best_fit_takes_the_fullest_row():
    rng = random.Random(4)
    for _ in range(50):
        lengths = [rng.randint(1, 64) for _ in range(rng.randint(0, 80))]
        rows: list[list[int]] = []
        for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
            free = [64 - sum(lengths[k] for k in r) for r in rows]
            fits = [f for f in free if f >= lengths[i]]
            if fits:
                rows[max(k for k, f in enumerate(free) if f == min(fits))].append(i)
            else:
                rows.append([i])
        got = token_matrix.best_fit(lengths, 64)
        assert sorted(i for r in got for i in r) == list(range(len(lengths)))
        assert sorted(sum(lengths[i] for i in r) for r in got) == sorted(sum(lengths[i] for i in r) for r in rows)


# packing


def test_boundaries_are_optimal():
    rng = random.Random(6)
    cost = lambda ends, counts, cut: sum(c * (min(b for b in cut if b >= e) - e) for e, c in zip(ends, counts, strict=True))
    for _ in range(200):
        ends = sorted(rng.sample(range(0, 60), rng.randint(1, 9)))
        counts = [rng.randint(1, 20) for _ in ends]
        for k in (1, 2, 3, 20):
            got = packing.boundaries(ends, counts, k)
            want = min(cost(ends, counts, (*c, ends[-1])) for n in range(min(k, len(ends))) for c in itertools.combinations(ends[:-1], n))
            assert len(got) <= k and got[-1] == ends[-1] and cost(ends, counts, got) == want
    assert packing.boundaries([], [], 4) == []


def check_packed(rows, lengths, budget):
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == Counter(lengths)
    batches = defaultdict(list)
    for r in rows:
        assert r["n_tokens"] <= r["bucket_len"]
        batches[r["batch_id"]].append(r)
    assert sorted(batches) == list(range(len(batches)))
    for b in batches.values():
        assert len({(r["bucket"], r["bucket_len"]) for r in b}) == 1
        assert sorted(r["slot"] for r in b) == list(range(len(b)))
        assert len(b) == 1 or len(b) * b[0]["bucket_len"] <= budget
    for bucket in {r["bucket"] for r in rows}:
        sizes = [len(b) for b in batches.values() if b[0]["bucket"] == bucket]
        assert sum(s < max(sizes) for s in sizes) <= 1


def test_packing(spark, sf):
    docs = documents(spark, sf)
    lengths = [(r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))) for r in docs.select("doc_id", "text").collect()]
    check_packed(packing.pack(docs, buckets=5, budget=4000).collect(), lengths, 4000)


def test_packing_of_odd_rows(odd, none):
    rows = packing.pack(odd, buckets=3, budget=50).collect()
    check_packed(rows, [(d, packing_bin) for d, packing_bin in ((d, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, _ in ODD)], 50)
    assert packing.pack(none).count() == 0


def test_long_lengths_get_the_least_padding(spark):
    """Lengths of many thousands: the padding is that of the best of all choices of boundaries."""
    rng = random.Random(7)
    lengths = sorted({rng.randint(4_000, 300_000) for _ in range(14)})
    rows = [(i, n) for i, n in enumerate(x for x in lengths for _ in range(rng.randint(1, 5)))]
    docs = spark.createDataFrame(rows, "doc_id long, n long").withColumn("text", F.lit(""))
    for k in (1, 2, 4, 7):
        got = packing.pack(docs, buckets=k, budget=1_000_000, length=F.col("n")).collect()
        check_packed(got, rows, 1_000_000)
        padding = sum(r["bucket_len"] - r["n_tokens"] for r in got)
        assert padding == min(sum(min(b for b in (*c, lengths[-1]) if b >= n) - n for _, n in rows) for m in range(k) for c in itertools.combinations(lengths[:-1], m))


def test_words_are_those_of_the_contracts(spark):
    texts = [None, "", " ", "one", " A\tb\x0bC\x0c\r\nd ", "a\x00b\x7fc", "Ünï_cöde-Wörd's 42", "x\x85y\u2028z\xa0w", "".join(map(chr, range(0x250))), "😀 a😀b İI", "  \n\n  "]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = rows.orderBy("i").select(common.plain_words(F.col("text")).alias("plain"), decontaminate.item_words(F.col("text")).alias("item")).collect()
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    assert [r["plain"] for r in got] == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert [r["item"] for r in got] == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t)) for t in texts]
