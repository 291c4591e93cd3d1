"""Page differencing: line reading, alignment and pairing against brute force."""

import random

import pytest

from tessera.llm import html_extract as H
from tests.conftest import SF_SMALL

PAGES = "page_id long, url string, html string, host string, text string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def brute_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("seed", range(30))
def test_shared_lines_are_a_longest_common_subsequence(seed):
    rng = random.Random(seed)
    a, b = [[rng.randint(0, rng.choice([2, 9])) for _ in range(rng.randint(0, 30))] for _ in range(2)]
    at = H.shared_lines(a, b)
    assert at == sorted(set(at)) and len(at) == brute_lcs(a, b)
    rest = iter(b)
    assert all(any(x == y for y in rest) for x in [a[k] for k in at])


def test_lines_of_broken_markup():
    page = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="nav"><nav><ul><li>menu</ul></nav>'
            '<!-- ad --><div class="ad">buy</div><article><h1>Head &amp line</h1><p><b>one\n two<br><p>three &lt;3 &eacute;&#33;<div id="user-comments"><p>me too</div>'
            "</div><p>four<form><input value='>'>send</form></article><footer>&copy; us</footer><div class=x>tail</di")
    got = H.lines(page)
    assert [t for t, drop, inside in got if inside and not drop] == ["Head & line", "one two", "three <3 é!", "four"]
    assert [t for t, drop, inside in got if drop] == ["menu", "buy", "me too", "send", "© us"]
    assert H.lines(None) == H.lines("") == H.lines("<script>only") == H.lines("<!-- open") == []
    assert [x[0] for x in H.lines("a < b <3 x<p>y</p")] == ["a < b <3 x", "y"]


@pytest.mark.parametrize("page", [
    '<div class="layout has-sidebar"><article><p>one</article></div>', '<main class="no-sidebar"><p>one</main>', '<div id="search-results"><p>one</div>',
    '<article class="post has-comments"><p>one</article>', '<form><nav>menu</nav><article><p>one</article></form>', '<form><p>one</form>',
    '<article><div class="entry-header"><h1>one</h1></div></article>', '<div class="sidebar-wrap widget"><main>one</main></div>',
    '<aside><article>teaser</article></aside><article>one</article>', '<article>one<div class="site-nav">x</div><div id="adSlot">y</div></article>',
    *[f"<{x}><article><p>one</article>" for x in ("button", "select", "svg", "noscript")],
    *[f"<{x}>menu<article><p>one</article><{x}>menu</{x}>" for x in ("button", "select")], "<button>menu</button><article>one</article>"])
def test_wrappers_do_not_empty_a_page(page):
    assert H.main_text(H.candidates(H.lines(page)), []) == "one"


def test_differencing_without_article(spark):
    head, foot = "<div>Site name</div><div>All rights</div>", "<div>Contact</div>"
    rows = [(k, f"http://h.example/a/{k}", f"{head}<p>body {k} first</p><p>body {k} second</p>{foot}") for k in range(12)]
    rows += [(90, "http://solo.example/", f"{head}<p>alone</p>{foot}"), (91, None, "<p>x</p>"), (92, "/relative", None), (93, "http://h.example/zz/1", ""),
             (None, "http://twin.example/1", "<p>same</p>"), (None, "http://twin.example/1", "<p>same</p>")]
    out = H.extract(table(spark, rows).repartition(5)).collect()
    assert len(out) == len(rows)
    by = {r.page_id: r for r in out}
    for k in range(12):
        assert by[k].text == f"body {k} first\n\nbody {k} second" and by[k].n_chars == len(by[k].text) and by[k].n_shared == 3
    assert by[90].text == "Site name\n\nAll rights\n\nalone\n\nContact"
    assert (by[91].text, by[92].text, by[93].text) == ("x", "", "")
    assert [r.text for r in out if r.page_id is None] == ["same", "same"]


def test_article_shared_by_two_pages_stays(spark):
    page = "<nav>a</nav><article><p>one</p><p>two</p></article><div>template</div>"
    out = H.extract(table(spark, [(1, "http://h.example/1", page), (2, "http://h.example/2", page)])).collect()
    assert [r.text for r in out] == ["one\n\ntwo"] * 2


def test_pairs_match_brute_force(spark):
    rng = random.Random(2)
    rows = [(k, f"https://h{rng.randint(0, 2)}.example/{rng.choice('ab')}/{rng.randint(0, 400)}", f"<p>c{rng.randint(0, 3)}</p><p>u{k}</p><p>c{rng.randint(0, 3)}</p>") for k in range(60)]
    got = {r.page_id: r.n_shared for r in H.extract(table(spark, rows)).collect()}
    keys = sorted((H.URL.match(u)[1], H.URL.match(u)[2], k) for k, u, _ in rows)
    marks = {k: [x[0] for x in H.lines(h)] for k, _, h in rows}
    paths = {k: [H.URL.match(u)[2]] for k, u, _ in rows}
    same_path = {k for _, p, k in keys if sum(q == p and h2 == h for h2, q, _ in keys for h, p2, _ in keys if p2 == p and h == h2) > 1}
    for i, (host, path, k) in enumerate(keys):
        two = [keys[j] for j in (i - 1, i + 1) if 0 <= j < len(keys) and keys[j][0] == host]
        if k in same_path or any(x[2] in same_path for x in two):
            continue  # the order of equal paths is that of the rows
        best = max(two, key=lambda x: H._common_prefix(path, x[1]), default=None)
        assert got[k] == (brute_lcs(marks[k], marks[best[2]]) if best else 0)
    assert paths


def test_whole_table(spark):
    out = H.op5_html_extraction(spark, SF_SMALL).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    assert len(out) == len(pages)
    for r in out:
        own = pages[r.page_id].html
        inside = own[own.index("<article>"):own.index("</article>")]
        assert "".join(H.lines(inside)[k][0] for k in range(len(H.lines(inside)))) == r.text.replace("\n\n", "")
    assert H.extract(table(spark, [])).count() == 0
