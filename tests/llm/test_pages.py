"""Page operators against plain code."""

import base64
import gzip
import hashlib
import io
import random
import re

import pytest

from helixframe.llm import html_text, warc

PAGES = [(3, "http://a.x/1", "<p>same</p>"), (1, "http://a.x/2", "<p>same</p>"), (2, None, "<p>same</p>"), (4, "u\r\nWARC-Type: x", None), (5, "http://b/", ""),
         (6, "v", "é\r\n\r\nWARC/1.1\r\n" * 3), (7, "w", "x" * 300_000), (7, "w", "x" * 300_000), (None, "n", "<p>same</p>"), (None, "m", "lone")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(i, u, h, "p", 7) for i, u, h in rows], "page_id long, url string, html string, digest string, block int")


def plain_digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def plain_revisits(rows, least=0):
    out = []
    for i, _, h in rows:
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        first = min(same, default=None)
        n = len((h or "").encode())
        again = n >= least and first is not None and i != first
        out.append((i, n, plain_digest(h), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def test_warc_round_trip_of_odd_rows(spark, tmp_path):
    for least in (0, 20):
        path = str(tmp_path / f"w{least}")
        warc.write_archives(pages(spark), path, least, archive_bytes=200_000)
        got = warc.resolve(warc.read_archives(spark, path))
        mine = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect()]
        assert sorted(mine, key=repr) == plain_revisits(PAGES, least)
        files = [warc.gzip.decompress(f.read_bytes()) for f in (tmp_path / f"w{least}").glob("part-*.gz")]
        assert len(files) > 1 and max(map(len, files)) < 16 * 200_000
        blocks = {(r["page_id"], bytes(r["block"])) for r in warc.read_archives(spark, path).collect() if r["record_type"] == "response"}
        want = {(i, (h or "").encode()) for i, _, h in PAGES if least > len((h or "").encode()) or (i, "response") in {(m[0], m[3]) for m in mine}}
        assert blocks == (want if least else want - {(None, b"<p>same</p>")})
    warc.write_archives(pages(spark).limit(0), str(tmp_path / "none"))
    assert warc.resolve(warc.read_archives(spark, str(tmp_path / "none"))).count() == 0


def test_warc_of_pages(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    got = [tuple(r) for r in warc.op7_warc(spark, sf).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=repr) == plain_revisits(rows)


def test_archives_are_plain_warc(spark, tmp_path):
    warc.write_archives(pages(spark, PAGES[:2]), str(tmp_path / "w"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "w").glob("part-*.gz")))
    got = {f[b"warc-type"]: (f, block) for f, block in warc.parse_archive(io.BytesIO(data))}
    assert got[b"response"][1] == b"<p>same</p>" and got[b"revisit"][1] == b""
    assert got[b"revisit"][0][b"warc-refers-to"] == got[b"response"][0][b"warc-record-id"]


def test_archives_are_bounded_by_bytes_and_ids_may_be_text(spark, tmp_path):
    rows = [(f"id <{i}> ü", f"u{i}", "x" * (i % 7) + str(i)) for i in range(300)] + [(f"long{i}", "u", chr(65 + i) * 40_000) for i in range(5)] + [("copy", "u", "A" * 40_000)]
    df = spark.createDataFrame(rows, "page_id string, url string, html string").repartition(2)
    warc.write_archives(df, str(tmp_path / "w"), archive_bytes=4_000)
    got = sorted(tuple(r) for r in warc.resolve(warc.read_archives(spark, str(tmp_path / "w"), "string")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    assert [(r[0], r[1], r[2]) for r in got] == sorted((i, len(h), plain_digest(h)) for i, _, h in rows)
    assert [r[0] for r in got if r[3] == "revisit"] == ["long0"] and [r[4] for r in got if r[0] == "long0"] == ["copy"]
    payload = [sum(len(b) for _, b in warc.parse_archive(io.BytesIO(gzip.decompress(f.read_bytes())))) for f in (tmp_path / "w").glob("part-*.gz")]
    assert max(payload) <= 16 * 4_000 and len(payload) > 3


def plain_article(page):
    """The text of <article>, for the tables' simple pages."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    body = re.sub(r"</?b>", "", body)
    parts = re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))
    import html

    return "\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


def test_article_text_of_pages(spark, sf):
    rows = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = html_text.op9_html_text(spark, sf).collect()
    assert sorted(r["page_id"] for r in got) == sorted(rows)
    for r in got:
        assert r["text"] == plain_article(rows[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == rows[r["page_id"]]["url"]


NAV = "<div>Home News Sport Weather Travel Culture Video</div>"
HTML = [
    (1, "http://h.x/a", f"{NAV}<div>first story has words of its own</div><p>tail one"),
    (2, "https://u@H.x:80/b", f"{NAV}<div>second story tells <i>some</i>thing else</div><div class='top cookie-bar'>We use cookies</div>"),
    (3, "http://other.x/", f"{NAV}<p>third"), (4, None, None), (5, "http://h.x/c", ""),
    (6, "http://h.x/d", "<header>Top</header><article class=story><header>Head &amp; line</header>a<br>b\n c<p>d &lt;&#x41;&gt; <p>e<aside>no</aside><div id=comments><p>no</div><form>no</form><script>if (a<b) '</p>'</script>f</article>g"),
    (7, "http://h.x/e", "1 < 2 <a href='x>y'>z</a> &am"), (7, "http://h.x/e", "1 < 2 <a href='x>y'>z</a> &am"), (None, "http://h.x/f", f"{NAV}<p>null id"),
    (8, "http://h.x/g", "<article>" + "<p>long one</p>" * 5000 + "<p cut"),
]


def test_host_repeats_and_roles(spark):
    df = spark.createDataFrame([(i, u, h, "k") for i, u, h in HTML], "page_id long, url string, html string, key string")
    got = sorted(((r["page_id"], r["text"]) for r in html_text.main_text(df).collect()), key=repr)
    assert got == sorted([(1, "first story has words of its own\ntail one"), (2, "second story tells something else"), (3, "Home News Sport Weather Travel Culture Video\nthird"), (4, ""), (5, ""),
                          (6, "Head & line\na b c\nd <A>\ne\nf"), (7, "1 < 2 z &am"), (7, "1 < 2 z &am"), (None, "null id"), (8, "\n".join(["long one"] * 5000))], key=repr)
    assert html_text.main_text(df.limit(0)).count() == 0


def plain_cover(rows, least):
    """Tokens of each page that lie in a run of `least` tokens found in another stream of its host."""
    pages_ = [(i, html_text.host_of(u), [w for r, t in html_text.blocks(h) if r != "main" for w in t.split(" ")]) for i, u, h in rows]
    grams = [{tuple(w[k : k + least]) for k in range(len(w) - least + 1)} for _, _, w in pages_]
    out = []
    for n, (_, host, w) in enumerate(pages_):
        others = set().union(*(g for m, g in enumerate(grams) if pages_[m][2] != w and pages_[m][1] == host))
        out.append({k + d for k in range(len(w) - least + 1) if tuple(w[k : k + least]) in others for d in range(least)})
    return pages_, out


@pytest.mark.parametrize("array_tokens", [1, 150, 500_000])
def test_unique_runs_equal_plain_search(spark, monkeypatch, array_tokens):
    monkeypatch.setattr(html_text, "ARRAY_TOKENS", array_tokens)
    rng = random.Random(8)
    rows = []
    for i in range(30):
        parts = [rng.choice(["a b c d e", "f g h i j k l m", "n o p q r s"]) if rng.random() < 0.6 else " ".join(rng.choice("uvwxyz") + str(rng.randrange(99)) for _ in range(6)) for _ in range(6)]
        rows.append((i, f"http://h{i % 2}/", "".join(f"<div>{p}</div>" for p in parts)))
    rows += [(90 + i, f"http://h{i % 2}/", rows[i % 2][2]) for i in range(4)]  # copies of whole pages keep their text
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"].split() for r in html_text.main_text(df).collect()}
    pages_, covers = plain_cover(rows, html_text.LEAST)
    for (i, _, words), cover in zip(pages_, covers, strict=True):
        assert got[i] == [w for k, w in enumerate(words) if k not in cover]
    assert got[90] == got[0] and any(got.values())


def test_suffix_runs_are_a_sorted_suffix_array():
    rng = random.Random(9)
    for _ in range(60):
        streams = [[rng.choice("abc") for _ in range(rng.randrange(14))] for _ in range(rng.randrange(1, 6))]
        hosts = [rng.randrange(2) for _ in streams]
        least = rng.randrange(1, 8)
        flat = [(h, s, k) for h, s in zip(hosts, streams, strict=True) for k in range(len(s))]
        want = {}
        for place, (h, s, k) in enumerate(flat):
            if k + least <= len(s):
                want.setdefault((h, tuple(s[k : k + least])), []).append(place)
        got = [r.tolist() for r in html_text.suffix_runs(hosts, streams, least)]
        assert sorted(map(sorted, got)) == sorted(want.values())
        assert [flat[r[0]][0] for r in got] == sorted(flat[r[0]][0] for r in got)


STRUCTURES = [
    ('<div class="wrap has-sidebar"><article><p>Body text', "Body text"),
    ('<article class="post share-enabled"><p>Body', "Body"),
    ('<main data-role="search-page" data-class="ad" data-id="comments"><p>Body', "Body"),
    ('<article><p>One<div class="related-work"><p>Two</div><p>Three', "One\nTwo\nThree"),
    ('<article><p>One<div class="ad">no</div><div class="cookie-bar">no</div><div id="comments">no</div><div class="related posts">no</div><p>Two', "One\nTwo"),
    ('<form id="aspnetForm"><div class="sidebar">no</div><article>Body</article></form>', "Body"),
    ('<div class="search"><article>Body</article></div>', "Body"),
    ('<article>Body</article><div class="comments"><article class="c1">a reader says</article></div>', "Body"),
    ('<div class="comments"><article class="comment">a reader says</article></div><main>Body</main>', "Body"),
    ('<aside><article>teaser</article></aside><main>Body</main>', "Body"),
    ('<article>One <span class="ad">no</span> two</article>', "One\ntwo"),
    ('<div role="banner">no</div><article role="article">Body<div role="navigation">no</div></article>', "Body"),
    ('<body class="search nav"><div class="content">plain words</div>', "plain words"),
    ('<div class="site-footer">no</div><div class="main-nav">no</div><p>plain words', "plain words"),
]


def test_what_is_beside_the_article(spark):
    df = spark.createDataFrame([(i, f"http://s{i}/", h) for i, (h, _) in enumerate(STRUCTURES)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    assert got == {i: t for i, (_, t) in enumerate(STRUCTURES)}


def test_a_page_is_parsed_once(spark, sf):
    plan = html_text.main_text(spark.read.parquet(f"{sf}/pages.parquet"))._jdf.queryExecution().toString()
    assert "pages.parquet" not in plan
