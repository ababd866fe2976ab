"""Main texts of layouts whose article is known."""

import random
import time

import pytest

from fleetlens.llm import html_text

BODY = "\n".join(f"Sentence number {k} of the article tells what happened at the harbour that day." for k in range(8))
PARAS = "".join(f"<p>{x}</p>" for x in BODY.split("\n"))
NOTES = "".join(f"<p>I quite agree with what was said above, reader {k}.</p>" for k in range(40))
MENU = "<ul><li><a href=/>Home</a><li><a href=/a>About</a></ul>"
#: Layout -> (page, expected text); {n} differs by page.
LAYOUTS = {
    "article": (f"<nav>{MENU}</nav><article><h1>Head {{n}}</h1>{PARAS}</article><footer>me</footer>", "Head {n}\n" + BODY),
    "wrapper with an unwanted word": (f'<div class="wrap has-sidebar"><div class="text"><h1>Head {{n}}</h1>{PARAS}</div><div class="sidebar">{MENU}<p>Buy now</p></div></div>', "Head {n}\n" + BODY),
    "post with comments": (f'<div class="post with-comments"><h1>Head {{n}}</h1>{PARAS}<div class="comments">{NOTES}</div></div>', "Head {n}\n" + BODY),
    "comments longer than the article": (f'<div class="story"><h1>Head {{n}}</h1>{PARAS}</div><div id="comments">{NOTES}</div>', "Head {n}\n" + BODY),
    "heading beside the container": (f'<div class="page"><div class="title"><h1>Head {{n}}</h1></div><div class="text">{PARAS}</div></div>', "Head {n}\n" + BODY),
    "site name in a heading": (f'<div class="brand"><h1>The Gazette</h1></div><div class="text"><h2>Head {{n}}</h2>{PARAS}</div>', "Head {n}\n" + BODY),
    "numbered classes": (f'<div class="post-{{n}} entry"><h1>Head {{n}}</h1>{PARAS}</div><div class="promo"><p>Cheap things for sale here</p></div>', "Head {n}\n" + BODY),
    "main with an aside": (f"<header><h1>Site</h1></header><main><h1>Head {{n}}</h1>{PARAS}<aside><p>See also</p></aside></main>", "Head {n}\n" + BODY),
    "unclosed paragraphs": ("<div class=text><h1>Head {n}</h1>" + "".join(f"<p>{x}" for x in BODY.split("\n")) + "</div><form><p>Mail<input></form>", "Head {n}\n" + BODY),
    "tables of layout": (f"<table><tr><td class=menu>{MENU}</td><td><div class=text><h1>Head {{n}}</h1>{PARAS}</div></td></tr></table>", "Head {n}\n" + BODY),
    "hidden notice": (f'<div style="display: none"><p>{"Accept all of it. " * 40}</p></div><div class=text><h1>Head {{n}}</h1>{PARAS}</div>', "Head {n}\n" + BODY),
    "cookie consent": (f'<div class="cookie-consent"><p>We use cookies to make this site better for you.</p></div><section><h1>Head {{n}}</h1>{PARAS}</section>', "Head {n}\n" + BODY),
    "two parts": (f'<div class="page"><div class="part-one"><h1>Head {{n}}</h1>{PARAS}</div><div class="part-two"><p>The second part {{n}} goes on about the harbour.</p>{PARAS}</div></div>', "Head {n}\n" + BODY + "\nThe second part {n} goes on about the harbour.\n" + BODY),
    "a lead": (f'<div class="page"><div class="lead"><p>In short {{n}}, much happened at the harbour.</p></div><div class="content"><h1>Head {{n}}</h1>{PARAS}</div></div>', "In short {n}, much happened at the harbour.\nHead {n}\n" + BODY),
    "a standfirst": (f'<body><div class="masthead"><p>The Gazette</p></div><div class="post-header"><h1>Head {{n}}</h1><p>What follows is day {{n}} at the harbour.</p></div><div class="content">{PARAS}</div></body>', "Head {n}\nWhat follows is day {n} at the harbour.\n" + BODY),
    "header of an entry": (f'<body><header class="site-header"><h1>The Gazette</h1></header><header class="entry-header"><h1>Head {{n}}</h1></header><div class="entry-content">{PARAS}</div><form><p>Your mail <input></p></form></body>', "Head {n}\n" + BODY),
    "a form around the page": (f'<body><form method=post action="/"><input type=hidden><div class="menu">{MENU}</div><div class="text"><h1>Head {{n}}</h1>{PARAS}</div><div class="footer"><p>Mail us</p></div></form></body>', "Head {n}\n" + BODY),
    "labels and buttons in a line": (f'<div class="text"><h1>Head {{n}}</h1><p>As <label for=x>noted</label> before<button>Copy</button>, it rained.</p>{PARAS}<form><label>Name</label><input><p>Write to us</p></form></div>', "Head {n}\nAs noted before, it rained.\n" + BODY),
    "text beside containers": (f"<h1>Head {{n}}</h1><p>On day {{n}} it began.</p><div class=text>{PARAS}</div>", "Head {n}\nOn day {n} it began.\n" + BODY),
    "note and caption around the body": (f'<article><h1>Head {{n}}</h1><div class="note">All times are local.</div><div class="text">{PARAS}</div><div class="end">Ends.</div></article><div class="legal">All rights are kept</div>', "Head {n}\nAll times are local.\n" + BODY + "\nEnds."),
    "three sections": (f'<body><div class="top"><p>The Gazette, a daily paper</p></div>' + "".join(f'<section class="s-{k}"><h2>Part {k} {{n}}</h2>{PARAS}</section>' for k in "abc") + "<div class=legal><p>All rights reserved by the Gazette</p></div></body>", "\n".join(f"Part {k} {{n}}\n{BODY}" for k in "abc")),
    "a list of links below": (f'<div class="page"><div class="text"><h1>Head {{n}}</h1>{PARAS}</div><div class="more"><a href=/1>Storm {{n}} breaks</a> <a href=/2>Flood {{n}} ends</a></div></div>', "Head {n}\n" + BODY),
    "same notice everywhere": (f'<div class="page"><div class="hint"><p>Readers of this paper are asked to keep it dry at all times, and to hand it on when it is read.</p></div><div class="text"><h1>Head {{n}}</h1>{PARAS}</div></div>', "Head {n}\n" + BODY),
    "definition lists": (f'<div class="text"><h1>Head {{n}}</h1><dl><dt>Tide {{n}}<dd>High at noon</dl>{PARAS}</div>', "Head {n}\nTide {n}\nHigh at noon\n" + BODY),
    "quotes and figures": (f'<article><h1>Head {{n}}</h1><blockquote><p>So said {{n}}.</p></blockquote><figure><img src=x><figcaption>The harbour {{n}}</figcaption></figure>{PARAS}</article>', "Head {n}\nSo said {n}.\nThe harbour {n}\n" + BODY),
    "nested wrappers": ("<div><div><div class=outer><div class=inner>" + f"<h1>Head {{n}}</h1>{PARAS}" + "</div></div></div></div>", "Head {n}\n" + BODY),
    "data table in the text": (f'<article><h1>Head {{n}}</h1>{PARAS}<table><tr><td>Day {{n}}</td><td>Boats</td></tr></table></article>', "Head {n}\n" + BODY + "\nDay {n}\nBoats"),
    "roles": (f'<div role="navigation">{MENU}</div><div role="main"><h1>Head {{n}}</h1>{PARAS}</div><div role="contentinfo"><p>Printed here</p></div>', "Head {n}\n" + BODY),
    "line breaks for paragraphs": ("<div class=text><h1>Head {n}</h1>" + BODY.replace("\n", "<br><br>") + "</div>", "Head {n}\n" + BODY.replace("\n", " ")),
    "share bar inside": (f'<div class="text"><h1>Head {{n}}</h1><div class="share-bar"><a href=/s>Share</a> this now</div>{PARAS}<div class="related"><p>Read also of the tide {{n}}</p></div></div>', "Head {n}\n" + BODY),
    "references and markup": ("<div class=text><h1>Head {n}</h1><p>A &lt;b&gt; &amp; c&nbsp;d <!-- no --><script>x<y</script>e</p>" + PARAS + "</div>", "Head {n}\nA <b> & c d e\n" + BODY),
}


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(f"{name}#{n}", f"http://h{k}.example/{n}", page.format(n="".join(chr(97 + int(c)) for c in str(n)))) for k, (name, (page, _)) in enumerate(LAYOUTS.items()) for n in range(5)]
    df = spark.createDataFrame([(i, u, h) for i, (_, u, h) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    return {name: got[i] for i, (name, _, _) in enumerate(rows)}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layout(texts, name):
    for n in range(5):
        assert texts[f"{name}#{n}"] == LAYOUTS[name][1].format(n="abcde"[n])


def test_links_only(spark):
    """Pages whose text is all links, on a host of such pages and beside articles, neither fail nor lose their text."""
    page = "<div><a href=a>one</a> <a href=b>two</a></div>"
    rows = [(k, f"http://links.example/{k}", page) for k in range(3)] + [(5, "http://mixed.example/1", page)] + [(6 + k, f"http://mixed.example/{k}", f"<div class=text><h1>Head {k}</h1>{PARAS}</div>") for k in range(3)]
    rows += [(20, "http://menu.example/", f'<div class="menu">{MENU}</div>'), (21, None, page), (22, "http://e.example", ""), (23, "http://e.example", None), (None, "http://e.example", "<p>only this</p>")]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == got[5] == got[21] == "one two" and got[20] == "Home\nAbout" and got[7] == "Head 1\n" + BODY and got[22] == got[23] == "" and got[None] == "only this"


def test_single_pages(spark):
    """Without other pages of the host, long text beside the container is kept, short lines aren't."""
    lead = "A long lead paragraph stands above the article and tells in a few words what it is going to be about."
    page = f'<div class="page"><div class="brand"><p>The Gazette</p></div><div class="lead"><p>{lead}</p></div><div class="content"><h1>Head</h1>{PARAS}</div></div>'
    assert html_text.extract(spark.createDataFrame([(1, "http://a.example", page)], "page_id long, url string, html string")).first().text == f"{lead}\nHead\n{BODY}"


def test_time_grows_with_the_page_not_with_its_depth():
    took = []
    for depth in (4000, 16000):
        page = "<div>" * depth + "<b>" * depth + "<p>deep text of the page</p>" * 50 + "</b>" * depth
        began = time.perf_counter()
        events = html_text.parse(page)
        winner = html_text.best_of(html_text.containers(events))
        assert html_text.main_text(events, winner).count("deep text") == 50
        took.append(time.perf_counter() - began)
    assert took[1] < 10 * took[0] + 0.5


def test_long_page(spark):
    rng = random.Random(3)
    words = " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(200_000))
    got = html_text.extract(spark.createDataFrame([(1, "http://a.example", f"<div><p>{words}</p></div>")], "page_id long, url string, html string")).first()
    assert got.text == words


def test_equal_scores_take_the_smaller_path():
    best = lambda scores: html_text.best_of({k: (v, v, 0) for k, v in scores.items()})
    assert best({(0, 5): 1, (0, 3): 1}) == (0, 3) and best({(0, 9): 1, (1, 2): 4}) == (0, 9)
    assert best({(0, 9): 1, (1, 2): 40}) == (1, 2) and best({}) is None and best({(0, 9): -3, (1, 2): 0}) is None
