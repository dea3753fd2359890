import os
import re
from html import unescape

import pytest

from headroom.llm import webpages as W

SF = "/root/testdata/sf0.001"
FILLER = " ".join(f"Sentence number {i} of a long text." for i in range(20))


def page(body, head="<title>x</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def by_scan(html):
    """The article of the test pages: blocks of what is between its tags."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner)
    return " ".join(filter(None, (" ".join("".join(unescape(t) if t[:1] != "<" else " " if t == "<br>" else "" for t in re.split(r"(<[^>]*>)", b)).split()) for b in blocks)))


CASES = {
    "boilerplate by tag": (f"<header><h1>Site</h1></header><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{FILLER}</p><aside>Side</aside><form>Name <input></form></article><footer>Foot</footer>", f"Title {FILLER}"),
    "boilerplate by class": (f"<div class='top-menu'>Menu</div><div class='post-body'><h1>Title</h1><p>{FILLER}</p></div><div id='comments'><p>{FILLER} {FILLER}</p></div><div class=adBox2 ><p>Buy</p></div><div class='cookie-notice'>We use</div>", f"Title {FILLER}"),
    "layout classes around the article": (f"<div class='page has-sidebar'><form id=f><div class='header-layout'><article><p>{FILLER}</p></article></div><div class='sidebar'><p>{FILLER}</p></div></form></div>", FILLER),
    "header in the article": (f"<article><header><h1>Title</h1><p>by someone</p></header><p>{FILLER}</p></article>", f"Title {FILLER}"),
    "comments as articles": (f"<main><article><p>{FILLER}</p></article><section class='comments-list'><article class='comment-3'><p>{FILLER} more</p></article></section></main>", FILLER),
    "unclosed tags": (f"<nav><ul><li><a>One<li><a>Two</ul></nav><article><p><b>Bold<br>part<p>{FILLER}<ul><li>one<li>t<i>w</i>o</ul>", f"Bold part {FILLER} one two"),
    "no article tag": (f"<div class=a1><a href=1>One</a> <a href=2>Two</a></div><div class=c2><h1>Title</h1><div><p>{FILLER}</p><p>Second</p></div></div>", f"Title {FILLER} Second"),
    "references and white space": ("<article><p>a&amp;b &lt;tag&gt; &#233;&#xe9; x&nbsp;\n\t y &unknown; &am</p><p>  </p><table><tr><td>1<td>2</table></article>", "a&b <tag> éé x y &unknown; &am 1 2"),
    "scripts and comments": ("<article><script>var t='</p><p>no';</script><!-- <p>no</p> --><p title='a>b'>yes</p><style>p{}</style>5 < 6<svg><text>no</text></svg></article>", "yes 5 < 6"),
    "nothing": ("<nav>Menu</nav>", ""),
    "links only": ("<article><p><a href=x>A link</a></p></article>", "A link"),
    "inline markup joins": ("<article><p>foo<b>bar</b>baz<span class='ad'>no</span></p></article>", "foobarbaz"),
}


@pytest.mark.parametrize("name", CASES)
def test_extracts(name):
    body, want = CASES[name]
    assert W.extract(page(body)) == want


def test_test_pages_by_a_plain_scan(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables are absent")
    out = W.op11_html_extraction(spark, SF).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(out) == len(pages)
    for r in out:
        assert r.text == by_scan(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def layout(article, notice):
    return page(f"<div class=wrap><div class='x7'><p>{article}</p></div><div class=y><p>{notice}</p></div></div>")


def test_consensus_of_the_host_overrules_a_misleading_page(spark):
    rows = [(i, f"https://Me@a.example.org:80/{i}", layout(f"{FILLER} {i}", "")) for i in range(5)]
    rows += [(9, "https://a.example.org/short", layout("A short one.", f"{FILLER} {FILLER}")), (10, "http://b.example.org/", layout("A short one.", f"{FILLER} {FILLER}"))]
    got = {r.page_id: r.text for r in W.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"{FILLER} {i}" for i in range(5)}, 9: "A short one.", 10: f"{FILLER} {FILLER}"}


def test_votes_match_brute_force(spark, monkeypatch):
    rows = [(i, f"http://h{i % 3}.example.org/{i}", page(f"<div class='c{i} k{'ab'[i % 5 > 2]}'><p>{FILLER}</p></div>")) for i in range(40)] + [(50, "http://e.example.org", "")]
    votes = {}
    for _, url, html in rows:
        votes.setdefault(url.split("/")[2], []).append(W.vote(html))
    want = {h: min((p for p in v if v.count(p) == max(map(v.count, v))), default="") for h, v in votes.items()}
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.host: r.path for r in W.host_paths(df).collect()} == want
    whole = sorted(map(tuple, W.main_texts(df).collect()))
    monkeypatch.setattr(W, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, W.main_texts(df).collect())) == whole


def test_nulls_repeats_long_clashing_columns_and_none(spark):
    long = " ".join(["word"] * 200_000)
    rows = [(None, None, None), (1, "not a url", ""), (2, "", f"<article>{long}</article>"), (3, "http://x/", "<p>same"), (3, "http://x/", "<p>same"), (4, "http://x/", "<" * 1000 + "<a title='" * 300)]
    want = [(None, None, "", 0), (1, "not a url", "", 0), (2, "", long, len(long)), (3, "http://x/", "same", 4), (3, "http://x/", "same", 4)]
    schema = "page_id long, url string, html string"
    out = [tuple(r) for r in W.main_texts(spark.createDataFrame(rows, schema)).collect()]
    assert sorted((r for r in out if r[0] != 4), key=str) == sorted(want, key=str) and len(out) == 6
    wide = spark.createDataFrame([(*r, 1, "x", "y", True) for r in rows], f"{schema}, n int, host string, path string, agreed boolean")
    assert sorted((tuple(r) for r in W.main_texts(wide).collect()), key=str) == sorted(out, key=str)
    assert W.main_texts(spark.createDataFrame([], schema)).count() == 0


def test_deep_and_broken_pages_end():
    assert W.extract("<div>" * 3000 + "deep") == "deep"
    assert W.extract("<b>" * 5000 + "<p>x" * 2000).count("x") == 2000
    assert W.extract("<article><p>text</p><!-- never closed <p>no</p>") == "text"
