"""Main text of web pages: made-up sites whose text is known, odd markup, and entropies counted plainly."""

import html
import math
import random
import re
from collections import Counter

import pytest

from tablekeeper.llm import sites
from tablekeeper.llm.queries import ORACLES, QUERIES, table

WORDS = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod tempor invidunt labore".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n))


def text_of(source, low=frozenset()):
    return sites.Page(source).text(low)[0]


def plain_article(source):
    """What the given tables hold: one article element of headings, paragraphs and inline marks."""
    inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    inner = re.sub(r"</?(?:h1|p|br)>", " ", inner)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", inner)).split())


def test_query_equals_plain_and_sql_names(spark):
    assert "op13_site_tree" in ORACLES
    for size in ("0.001", "0.01"):
        folder = f"/root/testdata/sf{size}"
        found = QUERIES["op13_site_tree"](spark, folder).collect()
        pages = {r["page_id"]: r for r in table(spark, folder, "pages").collect()}
        assert len(found) == len(pages)
        for r in found:
            page = pages[r["page_id"]]
            assert (r["url"], r["text"]) == (page["url"], plain_article(page["html"]))
            assert r["n_chars"] == len(r["text"])


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("just text", "just text"),
        ("<p>a<p>b<ul><li>c<li>d</ul>e", "a b c d e"),
        ("<body>x&amp;y &am &#233; &eacute &nosuch; 1 < 2 <3</body>", "x&y &am é é &nosuch; 1 < 2 <3"),
        ("<article>a<b>b</b>c<br>d  \n e</article>", "abc d e"),
        ("<p>out</p><article><h1>T</h1><p><b>un<p>closed</article><footer>f</footer>", "T un closed"),
        ("<main><p>x</p><section id='comments'><article><p>no</p></article></section></main>", "x"),
        ("<form id=aspnet><nav>m</nav><article>in a form<form>no<button>b</button></form></article></form>", "in a form"),
        ("<article><script>if (a < b) '</p>'</script><style>p{}</style>t<!-- <p>c --><!-->u</article>", "tu"),
        ("<title>t</title>text<textarea><p>no</textarea> more", "text more"),
        ('<div class="page-header">h</div><div class="cookieNotice">c</div><div id="sidebar-2">s</div><div>kept', "kept"),
        ('<div role="main">m<div role="search">s</div></div><div>d</div>', "m"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<article> \n </article><div>only this</div>", "only this"),
        ('<div title="a > b" class=x>q</div><a href="unclosed>r</a>', "q r"),
        ('<p>one <img alt="1"> two</p><hr>three<svg><text>no</text></svg>', "one two three"),
        ("<header><article>story</article></header><aside><article>teaser</article></aside>", "story"),
        ("<div class='article-body no-sidebar'><article class='post'>a</article></div>", "a"),
        ("<p class='down-load reloads'>names are whole words</p>", "names are whole words"),
        ("<!DOCTYPE html><?xml x?><![CDATA[z]]>after</nosuch>", "after"),
        ("<head><meta charset=x><p>body without a tag", "body without a tag"),
    ],
)
def test_odd_markup(source, text):
    assert text_of(source) == text


def test_very_long_and_deep_pages():
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert text_of(deep) == "x"
    words = "word " * 1_000_000
    assert text_of(f"<nav>n</nav><article><p>{words}</p></article>") == words.strip()
    assert text_of('<a "' * 50_000) == text_of("<" * 100_000 + " ")[:0]
    assert len(text_of("<p>x" * 100_000)) == 199_999


def template_site(rng, host, n, copies=0):
    """Pages without any declared part: a varying middle between the site's own lines."""
    top, bottom = sentence(rng, 6), sentence(rng, 9)
    rows, want = [], []
    same = sentence(rng, 30)
    for k in range(n):
        body = same if k < copies else sentence(rng, rng.randint(5, 40))
        more = "".join(f"<div class='t{rng.randint(0, 9)}'>{sentence(rng, 8)}</div>" for _ in range(0 if k < copies else rng.randint(0, 3)))
        rows.append((f"https://u@{host.upper()}:80/x{k}", f"<body><div class='z1'><div>{top}</div></div><div class='mid'><p>{body}</p>{more}</div><div id='q{k}'>{bottom}</div></body>"))
        want.append(" ".join(re.sub(r"<[^>]*>", " ", f"{body} {more}").split()))
    return rows, want


def test_tree_cuts_what_a_site_repeats(spark):
    rng = random.Random(1)
    rows, want = [], []
    for host, n, copies in (("a.example", 40, 0), ("b.example", 30, 10), ("c.example", 4, 0)):
        r, w = template_site(rng, host, n, copies)
        rows, want = rows + r, want + w
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string").repartition(7)
    odd = spark.createDataFrame([(100, None, "<p>no host"), (101, "nonsense", None), (102, "http://a.example/", None)], frame.schema)
    frame = frame.union(odd).selectExpr("*", "1 AS _doc", "'x' AS _main", "page_id AS _low", "url AS host")
    found = {r["page_id"]: r for r in sites.main_text(frame).collect()}
    assert [found[k]["_main"] for k in (100, 101, 102)] == ["no host", "", ""] and found[5]["host"] == rows[5][0]
    for i, w in enumerate(want):
        if i < 70:
            assert (found[i]["_main"], found[i]["_tree_cuts"], found[i]["_n_chars"]) == (w, 2, len(w))
        else:  # too few pages for a judgement
            assert w in found[i]["_main"] and found[i]["_tree_cuts"] == 0
    assert sites.main_text(frame.limit(0)).count() == 0


def test_a_host_of_copies_keeps_its_text(spark):
    rows = [("http://copies.example/", "<body><div>All the same.</div></body>")] * 50
    found = sites.main_text(spark.createDataFrame(rows, "url string, html string")).collect()
    assert {(r["_main"], r["_tree_cuts"]) for r in found} == {("All the same.", 0)}


def test_importance_equals_plain_entropies(spark):
    rng = random.Random(5)
    texts = ["a", "b", "b", "c"] * 5
    rows = [("http://h/", f"<div>{t}</div>{'<p>' if rng.random() < 0.3 else ''}") for t in texts] + [("http://one/", "<div>x")]
    frame = spark.createDataFrame(rows, "url string, html string")
    nodes = {(r["host"], r["node"]): r for r in sites.style_tree(frame).collect()}
    div = sites.hashed(0, "div.#")

    def entropy(values):
        m = len(values)
        return -sum(n / m * math.log(n / m, m) for n in Counter(values).values())

    got = nodes["h", div]
    assert got["pages"] == 20 and got["presentation"] == 0
    assert got["content"] == pytest.approx(entropy(texts)) and got["importance"] == pytest.approx(entropy(texts))
    assert nodes["one", div]["importance"] == 1


def test_tree_judges_the_article_too(spark):
    rng = random.Random(9)
    rows, want = [], []
    body = lambda h, p, more: f"<article><h1>{h}</h1><p>{p}</p><div class=z1>Share <b>this</b> story</div>{more}</article>"
    for k in range(60):
        p = f"<b>Alike</b> {sentence(rng, 12)}"
        rows.append(("http://news.example/", body("One title", p, "")))
        want.append(" ".join(re.sub(r"<[^>]*>", " ", f"One title {p}").split()))
    copy = body("Copied", "the same", "")
    rows += [("http://copies.example/", copy)] * 40 + [("http://few.example/", body("T", "few pages", ""))] * 3
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, url string, html string").repartition(5)
    found = {r["id"]: (r["_main"], r["_tree_cuts"] > 0) for r in sites.main_text(frame).collect()}
    assert [found[k] for k in range(60)] == [(w, True) for w in want]
    assert {found[k] for k in range(60, 100)} == {("Copied the same Share this story", False)}
    assert {found[k] for k in range(100, 103)} == {("T few pages Share this story", False)}
