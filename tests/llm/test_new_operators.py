"""Periodic runs, main text of pages, Merkle manifest: against plain versions and cases made for them."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from cellquant.llm import html, merkle, periodic, queries
from tests.llm import plain

BODY = ["A first paragraph that says what the article is about, at some length.", "Short.", "A third one, with a link and some more words to it, ends the text."]
EXTRAS = {
    "menu": "<nav><ul><li><a href='/a'>Home page</a><li><a href=/b>News of the day, quite long</a></ul></nav>",
    "header": "<header><p>The site of many long words, which stands above each page of it</p></header>",
    "footer": "<footer>&copy; 2020 The site, all rights reserved, and a long line below each page</footer>",
    "sidebar": "<aside><h2>Also read</h2><p>Another article of ours, which is told here in many words.</p></aside>",
    "notice": "<div class='cookie-notice'><p>We use cookies to make this site better, do you accept them all?</p></div>",
    "advert": "<div id=\"adBox\"><p>Buy this now, it is cheaper than it has ever been, for a few days only.</p></div>",
    "form": "<form action='/s'><label>Your name and your address</label><input name=q><textarea>Say <b>it</b></textarea></form>",
    "script": "<script>if (a < b) document.write('<p>written text of some length</p>');</script><style>p > b {}</style>",
    "comments": "<section class=\"comments\"><h3>2 comments</h3><article class='comment'><p>I liked this one very much, thank you for it.</p></article></section>",
    "hidden": "<div style='display: none'>Text that nobody sees on the page, whatever it says</div><!-- a remark > with <p>markup</p> -->",
}


def _page(where: str, extra: str, wrap: str = "article") -> str:
    before, inside, after = (extra if where == w else "" for w in ("before", "inside", "after"))
    close = wrap.split()[0]
    body = f"<h1>Title &amp; more</h1><p>{BODY[0]}{inside}<p><b>{BODY[1]}<p>{BODY[2].replace('a link', '<a href=x?a=1&b=2>a&nbsp; link</a>')}</p>"
    return f"<!DOCTYPE html><html class=has-sidebar><head><title>T</title><meta charset=utf-8></head><body>{before}<{wrap}>{body}</{close}>{after}"


@pytest.mark.parametrize("where", ["before", "inside", "after"])
@pytest.mark.parametrize("wrap", ["article", "main class='content with-ads'", "div"])
@pytest.mark.parametrize("extra", sorted(EXTRAS))
def test_page_text(where, wrap, extra):
    if extra == "header" and where == "inside" and wrap != "div":
        return  # the header of an article is part of it
    assert html.page_text(_page(where, EXTRAS[extra], wrap)) == "\n".join(["Title & more", *BODY])


def test_page_text_by_distribution():
    """Without marks of any kind, lines far from the text stay out."""
    far = "<table><tr><td><div><div>{}</div></div></td></tr></table>"
    page = far.format("Site of long words") + "<div>" + "".join(f"<p>{b}</p>" for b in BODY * 3) + "</div>" + far.format("All rights reserved")
    assert html.page_text(page) == "\n".join(BODY * 3)
    assert html.distribution([5, 0, 0, 0, 2]).tolist() == [5, 0, 2, 2, 2]
    assert html.surges([5, 0, 0, 0, 90, 1], 80) == [(2, 6)]


def test_links_and_names():
    links = "<p><a href=/>Home</a></p><p><a href=/n>News</a></p>"
    title = "<h2><a href=/t>A title that is a link</a></h2>"
    assert html.page_text(f"{links}{title}<p>{BODY[0]}</p>{links}") == f"A title that is a link\n{BODY[0]}"
    assert html.page_text(f"<article>{title}<p>{BODY[0]}</p><p><a href=x>Source</a></p></article>{links}") == f"A title that is a link\n{BODY[0]}\nSource"
    assert html.page_text(f"<article><p>{BODY[0]}</p><ul>{'<li><a href=x>Page</a>' * 6}</ul><p>End.</p></article>") == f"{BODY[0]}\nEnd."
    for name in ("cookiebar", "commentsection", "siteFooter", "main-menu", "adbox", "left_ad top"):
        assert html.page_text(f"<div><p>{BODY[0]}</p></div><div class='{name}'><p>{BODY[2]}</p></div>") == BODY[0], name
    for name in ("commentary", "has-sidebar", "post-header", "article header-large", "no_comments", "admin"):
        assert html.page_text(f"<div class='{name.split()[0]}'><p>{BODY[0]}</p></div>") == BODY[0], name


def test_page_text_of_odd_pages():
    assert [html.page_text(t) for t in (None, "", " ", "<", "<p", "<!--", "<script>x", "a <b", "</p>")] == ["", "", "", "<", "", "", "", "a", ""]
    assert html.page_text("<h2>Comments</h2><p>one<p>two") == ""
    assert html.page_text("<article><p>text &lt;p&gt; &#65;&unknown; \x0b more<p>end<h4>3 Comments</h4><p>mine</article>") == "text <p> A&unknown; more\nend"
    assert html.page_text('<p title="a > b">one<br>two</p>') == "one two"
    long = "<p>" + "word " * 300_000 + "</p>" + "<div>" * 3000 + "x"
    assert html.page_text(long).startswith("word word") and len(html.page_text(long)) >= 300_000 * 5 - 1


def test_main_text_of_tables(spark):
    rows = [(1, "<article><p>one two</article>", "a"), (1, "<article><p>one two</article>", "b"), (None, None, None)]
    got = html.main_text(spark.createDataFrame(rows, "page_id long, html string, TEXT string")).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [(0, ""), (1, "one two"), (1, "one two")]
    empty = html.main_text(spark.createDataFrame([], "html string, url string"))
    assert empty.columns == ["html", "url", "text"] and empty.count() == 0


def _runs(words, least):
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least:
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_those_of_a_plain_search(seed):
    r = random.Random(seed)
    for _ in range(150):
        words = [b"%d" % r.randrange(r.choice([1, 2, 3, 30])) for _ in range(r.randrange(90))]
        if words and r.random() < 0.5:
            a = r.randrange(len(words))
            p = 1 + r.randrange(len(words) - a)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        least = r.choice([2, 5, 12])
        assert periodic.runs_of(words, least) == _runs(words, least)


def test_runs_of_long_texts():
    a, b = [b"0"], [b"0", b"1"]
    while len(b) < 3000:
        a, b = b, b + a
    assert periodic.runs_of(b[:3000]) == _runs(b[:3000], 12)
    words = [b"%d" % i for i in range(500)] + [b"x", b"y", b"z"] * 20_000
    assert periodic.runs_of(words) == [(500, 60_000, 3)]
    assert periodic.collapsed(words, [(500, 60_000, 3)]).split() == words[:503]


def test_periodic_runs_of_tables(spark):
    line = "so it goes on and on "
    rows = [(3, line * 4, "x"), (3, line * 4, "x"), (None, "a b c", "y"), (4, None, "z"), (5, " \t\n", "z"), (6, "é " * 30, None)]
    got = periodic.runs_digest(periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs string"))).collect()
    found = sorted((r.doc_id or 0, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.collapsed_sha256) for r in got)
    sha = plain.sha
    assert found[0] == (0, 0, None, None, None, None, sha("a b c"))
    assert found[1] == found[2] == (3, 1, 0, 24, 6, 4000, sha(line.strip()))
    assert found[3:] == [(4, 0, None, None, None, None, sha("")), (5, 0, None, None, None, None, sha("")), (6, 1, 0, 30, 1, 30000, sha("é"))]
    assert {r.runs_sha256 for r in got if r.doc_id == 3} == {sha("0,24,6\n")}
    assert periodic.periodic_runs(spark.createDataFrame([], "text string, doc_id long")).count() == 0


def test_planted_stretches():
    for i in range(400):
        words = [b"%d" % k for k in range(i % 50)]
        h, n, got = zlib.crc32(b"%d" % i), i % 50, queries._planted(i, words)
        a, p = (h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)) if h % 10 == 0 and n else (n, 1)
        assert got == [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]


def _levels(row):
    out = [row]
    while len(out[-1]) > 1:
        out.append([plain.sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def _manifest(rows):
    """(doc_id, leaf, subroot, root, siblings) of (doc_id, group, text)."""
    leaf = lambda r: plain.sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    groups = sorted({r[1] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    sorted_ = [sorted((r for r in rows if r[1] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in groups]
    trees = [_levels([leaf(r) for r in rs]) for rs in sorted_]
    top = _levels([t[-1][0] for t in trees])
    way = lambda t, i: [x[i >> k ^ 1] for k, x in enumerate(t[:-1]) if i >> k ^ 1 < len(x)]
    return [(r[0], leaf(r), t[-1][0], top[-1][0], way(t, i) + way(top, g)) for g, (rs, t) in enumerate(zip(sorted_, trees, strict=True)) for i, r in enumerate(rs)]


@pytest.mark.parametrize("n, groups", [(0, 1), (1, 1), (530, 40)])
def test_manifest(spark, n, groups):
    r = random.Random(n)
    rows = [(None if i == 3 else i // 2, r.choice([None, *map(chr, range(230, 229 + groups))]) if groups > 1 else "g", r.choice([None, "", "é" * i])) for i in range(n)]
    rows += rows[:2]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    leaves = docs.select("doc_id", F.col("lang").alias("tree"), merkle.leaf_hash("doc_id", "lang", "text").alias("leaf"), F.lit(1).alias("place"))
    got = merkle.manifest(leaves, "tree", ["doc_id"], "leaf").withColumn("siblings", merkle.siblings())
    got = got.withColumns({"folded": merkle.folded(F.col("leaf")), "wrong": merkle.folded(F.lit(plain.sha("")))}).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, x[1], x[4])
    found = sorted([(x.doc_id, x.leaf, x.subroot, x.root, [s for s in x.siblings if s]) for x in got], key=key)
    assert found == sorted(_manifest(rows), key=key)
    assert all(x.folded == x.root != x.wrong and x.place == 1 for x in got)
