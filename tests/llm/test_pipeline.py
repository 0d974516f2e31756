"""The pipeline's stages against plain code."""

import re
from collections import defaultdict

import corpus_pipeline
from test_documents import ITEMS
from test_near_copies import plain_kept

from helixframe.llm.entry import QUERIES, SQL


def test_stages_keep_the_columns_and_take_effect(spark):
    long = "one line that stands in many documents of this small corpus"
    base = "the quick brown fox jumps over the lazy dog and runs into the wide green forest to hide from all the hunters"
    rows = [(1, base, "en"), (2, base + "!", "en"), (3, f"{long}\nwhat is new here is the weather of today", "en"), (4, f"{long}\nand the other one tells of the storms at sea", "en"),
            (5, f"{long}\nthe third is about a house by the river", "en"), (6, "see: " + ITEMS[0][1] + " and more of the same", "en"), (7, "12 34", "en"), (8, None, "en"), (9, "", None)]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or ""), 1.5) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, fp double")
    names = [n for n, _ in corpus_pipeline.STAGES]
    step = dict(corpus_pipeline.STAGES)
    got = step["language_id"](spark, docs, "")
    assert got.columns == docs.columns and sorted(r[0] for r in got.collect()) == [1, 2, 3, 4, 5, 6]
    got = step["line_dedup"](spark, got, "")
    texts = {r["doc_id"]: r for r in got.collect()}
    assert texts[3]["text"] == "what is new here is the weather of today" and texts[3]["n_chars"] == 40 and texts[5]["text"] == rows[4][1]
    got = step["simhash"](spark, got, "")
    assert got.columns == docs.columns and len({r["doc_id"] for r in got.collect()} & {3, 4, 5, 6}) == 4
    assert names[-2:] == ["decontamination", "packing"]
    assert step["packing"](spark, got, "").columns[0] == "doc_id"


def plain_lines_dropped(rows):
    """(doc_id, text) after line dedup."""
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    where = defaultdict(set)
    for d, t in rows:
        for x in t.split("\n"):
            where[key(x)].add(d)
    gone = lambda d, x: len(key(x)) >= 20 and len(where[key(x)]) >= 3 and d != max(where[key(x)])
    return [(d, "\n".join(x for x in t.split("\n") if not gone(d, x))) for d, t in rows]


def plain_contaminated(text, windows):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return any(tuple(words[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1))


def test_run_equals_plain_code_on_every_row(spark, sf):
    """Languages are the operator's own, which has tests of its own; all that follows is plain code."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in corpus_pipeline.identify_language(spark, docs, sf).select("doc_id", "text").collect()]
    texts = dict(plain_lines_dropped(rows))
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
        windows |= {tuple(own[i : i + 10]) for i in range(max(1, len(own) - 9)) if own}
    want = {d: len(re.findall(r"[^\x20\x09-\x0D]+", texts[d])) for d in plain_kept(list(texts.items())) if not plain_contaminated(texts[d], windows)}
    got = corpus_pipeline.run(spark, sf).collect()
    assert len(got) == len({(r["batch_id"], r["slot"]) for r in got}) == len(want) > 100
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 11))
    assert set(SQL) <= set(QUERIES) and corpus_pipeline.ORACLE_SQL is None
