import pytest

from sievekit.llm import pages as G

SCHEMA = "page_id long, url string, html string"


def page(body, cls="post-12", extra=""):
    return (f"<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body>"
            f"<header>Site</header><nav><ul><li><a href='/a'>Menu</a></li></ul></nav><div class='cookie-notice'>Accept</div>"
            f"<div class=\"{cls}\">{body}</div>{extra}<aside>side</aside><div class='ad banner'>Buy</div>"
            f"<form><p>Subscribe now please</p></form><div class='comments'><p>First! a long reader comment here, really long</p></div>"
            f"<footer>&copy; 2020</footer></body></html>")


BODY = "<h1>Title&nbsp;here</h1><p>First   <b>para</b>\n of text &lt;x&gt;.</p><p>Second<br>line <i>é</i> &#233;</p><ul><li>one</li><li>two</li></ul>"
TEXT = "Title here\nFirst para of text <x>.\nSecond\nline é é\none\ntwo"


def test_main_text_of_a_page():
    assert G.extract(page(BODY), None) == TEXT
    assert G.extract(page(BODY), ["/html/body/div.post-#"]) == TEXT
    assert G.extract(page(BODY), ["/html/body/main"]) == TEXT


@pytest.mark.parametrize("source,text", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<", "<"), ("<p>a<b>b", "ab"), ("<div><p>a</div><p>b", "a\nb"),
    ("<script>x", ""), ("<!-- c --><p>a&am", "a&am"), ("<p>a &amp", "a &"), ("<p class='x>y'>q</p>", "q"), ("<a href=\"x>y", "y"),
    ("<nav>only</nav>", ""), ("a < b > c", "a < b > c")])
def test_malformed_pages(source, text):
    assert G.extract(source, None) == text


def test_consensus_overrules_one_page(spark):
    """A page whose sidebar outweighs its article follows its host."""
    short = page("<p>Short article.</p>", extra="<div class='teasers'>" + "<p>Other long story text, quite long indeed.</p>" * 6 + "</div>")
    rows = [(i, f"https://h.example/{i}", page(BODY + "<p>More text of the article follows here.</p>" * 3, f"post-{i}")) for i in range(9)]
    rows += [(100, "https://h.example/x", short), (101, None, short), (102, "::bad::[", page(BODY)), (103, "https://h.example/n", None)]
    got = {r.page_id: (r.text, r.n_chars) for r in G.main_texts(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert got[100][0] == "Short article."
    assert got[101][0].startswith("Other long story")
    assert got[102][0] == TEXT and got[103] == ("", 0)
    assert all(n == len(t) for t, n in got.values()) and len(got) == 13
    w = {r.host: r.winners for r in G.winning_paths(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert w == {"h.example": ["/html/body/div.post-#"]}


def test_edges(spark):
    assert G.main_texts(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "http://a", "<p>x</p>", 1, 2), (1, "http://a", "<p>x</p>", 1, 2), (None, None, None, 1, 2)]
    got = G.main_texts(spark.createDataFrame(rows, SCHEMA + ", host int, winners int")).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [(0, ""), (1, "x"), (1, "x")]


def test_very_long_and_deep_pages():
    assert G.extract("<div>" * 3000 + "deep" + "</div>" * 3000, None) == "deep"
    assert len(G.extract("<article>" + "<p>words and words</p>" * 30_000 + "</article>", None).split("\n")) == 30_000
    assert G.extract("<a href=\"" * 2000, None) is not None


def fill(n, word="text"):
    return " ".join(f"{word}{i}" for i in range(n)) + "."


LONG, OTHER = fill(40), fill(25, "more")
SHAPES = {
    "title and lead before the body": ("<article><h1>T</h1><p>lead words</p><div class=body><p>" + LONG + "</p><p>" + OTHER + "</p></div></article>",
                                       f"T\nlead words\n{LONG}\n{OTHER}"),
    "the same without an article": ("<div class=wrap><h1>T</h1><p>lead words</p><div class=body><p>" + LONG + "</p></div></div>", f"T\nlead words\n{LONG}"),
    "sibling sections": (f"<section class=a><p>{OTHER}</p></section><section class=b><p>{LONG}</p></section>", f"{OTHER}\n{LONG}"),
    "layout has-sidebar": (f"<div class='layout has-sidebar'><p>{LONG}</p></div>", LONG),
    "no-comments": (f"<div class='page no-comments'><p>{LONG}</p></div>", LONG),
    "self-closed svg": (f"<div class=post><svg viewBox='0 0 1 1'/><p>{LONG}</p><p>{OTHER}</p></div>", f"{LONG}\n{OTHER}"),
    "custom tag": (f"<div class=post><object-view><p>{LONG}</p><p>{OTHER}</p></div>", f"{LONG}\n{OTHER}"),
    "unclosed object": (f"<div class=post><object><p>{LONG}</p></div>", LONG),
    "math": (f"<div class=post><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p></div>", f"{LONG} x=1"),
    "all text in a side container": (f"<div class=sidebar><p>{LONG}</p></div>", LONG),
    "nested articles": (f"<main><article><p>{LONG}</p><article><p>{OTHER}</p></article></article></main>", f"{LONG}\n{OTHER}"),
    "a list of articles": ("<main>" + "".join(f"<article><p>{fill(20, w)}</p></article>" for w in "abc") + "</main>",
                           "\n".join(fill(20, w) for w in "abc")),
    "side containers": (f"<div class=post><p>{LONG}</p><div class='related-posts'>r</div><div id=comments><p>{LONG} {LONG}</p></div>"
                        f"<div class='share-buttons'>s</div><div role=navigation>n</div></div>", LONG),
}


@pytest.mark.parametrize("name", SHAPES)
@pytest.mark.parametrize("around", [False, True])
def test_shapes_keep_the_article_whole(name, around):
    body, text = SHAPES[name]
    source = (f"<html><head><title>x</title></head><body><nav><a href=/>Home</a></nav>{body}<footer>f</footer></body></html>" if around else body)
    assert G.extract(source, None) == text


def test_generated_pages_keep_their_article():
    """Random wrappers, leads, sections and side containers around known article text."""
    import random
    for seed in range(200):
        r = random.Random(seed)
        paras = [fill(r.randrange(5, 30), f"p{i}") for i in range(r.randrange(1, 6))]
        inner = "".join(f"<p>{p}</p>" for p in paras)
        kind = r.choice(["article", "main", "div class=entry", "div class='content has-sidebar'"])
        lead = r.choice(["", "<h1>Title</h1>", "<h1>Title</h1><p>A lead.</p>"])
        if r.random() < 0.5:
            inner = f"<div class=body>{inner}</div>"
        source = f"<{kind}>{lead}{inner}</{kind.split()[0]}>"
        for _ in range(r.randrange(3)):
            source = f"<div class=w{r.randrange(9)}>{source}</div>"
        side = ["<div class='ad'>buy this now</div>", "<aside>about us</aside>", "<nav><a href=/>Home</a></nav>", "<div class=cookie-notice>ok?</div>",
                "<svg width=1 />", "<form><p>your mail please</p></form>", "<div class='newsletter box'>join</div>", "<!-- note -->"]
        source = "".join(r.sample(side, 3)) + source + "".join(r.sample(side, 3))
        want = [*([] if not lead else ["Title"]), *(["A lead."] if "lead" in lead else []), *paras]
        assert G.extract(f"<html><body>{source}</body></html>", None) == "\n".join(want), seed


def test_two_templates_on_a_host(spark):
    """The winning path with most text on the page is taken, not the one with most votes."""
    teaser = "<div class=teaser><p>Short teaser text.</p></div>"
    rows = [(i, f"http://H.example:80/{i}", f"<body>{teaser}<div class=side-note></div></body>") for i in range(8)]
    rows += [(100 + i, f"http://h.example/a{i}", f"<body>{teaser}<div class=story><p>{LONG}</p></div></body>") for i in range(3)]
    rows += [(200, "http://h.example/one", f"<body>{teaser}<article><p>{OTHER}</p></article></body>")]
    got = {r.page_id: r.text for r in G.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0] == "Short teaser text." and got[101] == LONG and got[200] == OTHER


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_winners_joined_or_broadcast_alike(spark, monkeypatch, limit):
    monkeypatch.setattr(G, "BROADCAST_CHARS", limit)
    rows = [(i, f"http://h{i % 3}.example/{i}", page(BODY, f"post-{i}")) for i in range(30)] + [(99, None, "<p>x</p>"), (None, "http://h0.example", None)]
    got = {r.page_id: r.text for r in G.main_texts(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert len(got) == 32 and got[99] == "x" and got[None] == "" and all(got[i] == TEXT for i in range(30))
