"""The pipeline's near-duplicate stage against every pair of sets."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
from test_documents import documents


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_kept(rows):
    """doc_ids that stay of (doc_id, text), by exact similarity of all sets that share a shingle."""
    first = {}
    for d, t in rows:
        s = plain_shingles(t)
        first[s] = min(d, first.get(s, d))
    sets = list(first)
    at = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in at[x] if j < i).items():
            if 5 * both >= 4 * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, s in enumerate(sets):
        least[find(i)] = min(first[s], least.get(find(i), first[s]))
    return sorted(least.values())


def stage(spark, docs):
    return dict(corpus_pipeline.STAGES)["simhash"](spark, docs, "")


def test_similarity_just_above_and_below(spark):
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    rows = []
    for k in range(0, 200, 10):  # 80 shingles; 20 more make 0.8, 21 more less
        rows += [(k, words(k, 84)), (k + 1, words(k, 104)), (k + 2, words(k + 1, 84)), (k + 3, words(k + 1, 105))]
    rows += [(500 + i, words(900, 104 + 20 * i)) for i in range(4)]  # a chain, whose ends are not near
    got = sorted(r["doc_id"] for r in stage(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == plain_kept(rows) == sorted([k + i for k in range(0, 200, 10) for i in (0, 2, 3)] + [500])


def test_a_hot_group_with_a_second_component(spark):
    base = [f"w{i}" for i in range(104)]
    rows = [(i, " ".join([*base[: i % 100], f"z{i}", *base[i % 100 + 1 :]])) for i in range(300)]
    rows += [(1000 + i, " ".join([*base[:60], *(f"v{j}" for j in range(44 - i))])) for i in range(5)]
    got = sorted(r["doc_id"] for r in stage(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == plain_kept(rows) and len(got) < 20


def test_a_hot_group_of_heavily_and_lightly_edited_copies(spark):
    """Copies with much text of their own are near none; all of them share most of their bands."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]

    def edited(i, n):
        words = list(base)
        for k in rng.sample(range(150), n):
            words[k] = f"e{i}x{k}"
        return " ".join(words)

    rows = [(i, edited(i, rng.choice([0, 1, 1, 2, 3, 5, 7, 9]))) for i in range(400)]
    got = sorted(r["doc_id"] for r in stage(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == plain_kept(rows) and 50 < len(got) < 300


def test_every_row_of_a_table(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(r["doc_id"] for r in stage(spark, docs).collect()) == plain_kept(rows)


def test_odd_rows(spark):
    text = "one two three four five six"
    rows = [(1, text, 1), (1, text, 1), (1, "another text of that very document", 2), (2, text.upper(), 3), (None, text, 4), (None, text, 4), (3, None, 5), (4, " ", 6), (5, "few words", 7), (5, "few words", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tie int")
    got = stage(spark, docs)
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
    assert kept == sorted([(1, text), (1, rows[2][1]), (None, text), (None, text), (3, None), (5, "few words")], key=repr)
    assert stage(spark, docs.where("false")).count() == 0
