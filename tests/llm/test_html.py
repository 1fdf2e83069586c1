import itertools
import random

import pytest
from pyspark.sql import functions as F

from tradebars.llm import html

SCHEMA = "page_id bigint, url string, html string"
NAV = "<nav><ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in "home news about contact shop".split()) + "</ul></nav>"
FOOT = "<footer>&copy; 2024 example.org &middot; all kinds of words in a footer that nobody reads at all</footer>"


def page(body, i=0):
    return f"<!DOCTYPE html><html><head><title>Title of {i}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{NAV}<!-- x --><div class=\"ad\">Buy this now or later</div>{body}{FOOT}</body></html>"


LONG = " ".join(f"word{i}" for i in range(30))
CASES = [
    (f"<article><h1>A &amp; B</h1><p>One\n\t two&nbsp;<b>th</b>ree &lt;4&gt;</p><p>{LONG}<br>next</p></article>", f"A & B One two three <4> {LONG} next"),
    (f"<main><p>{LONG}</p><aside>side box words here</aside><div class='newsletter-signup'>Sign up for mail</div><p>{LONG} end</p><section id=comments><p>First! nice read, thanks a lot for this</p></section></main>", f"{LONG} {LONG} end"),
    (f"<div id='content'><h2>Head</h2><p>{LONG}<p>{LONG}</div>", f"Head {LONG} {LONG}"),
    ("", ""),
    (f"<article><p>unclosed {LONG}", f"unclosed {LONG}"),
]


def pages(spark, extra=()):
    training = [(1000 + i, "u", page(f"<article><h1>Title {i}</h1>" + "".join(f"<p>{LONG} {i} {j}</p>" for j in range(1 + i % 4)) + "</article>", i)) for i in range(20)]
    mine = [(i, f"http://e.org/{i}", page(b, i) if b != CASES[4][0] else page("").split(FOOT)[0] + b) for i, (b, _) in enumerate(CASES)]
    return spark.createDataFrame(training + mine + list(extra), SCHEMA)


def test_main_text(spark):
    odd = [(50, None, None), (51, "", ""), (52, "u", "<p"), (53, "u", "a < b & c <3"), (None, "u", page(CASES[0][0]))]
    docs = pages(spark, odd + odd[:1])
    out = html.extract(docs.withColumn("text", F.lit("clash"))).collect()
    assert len(out) == docs.count()
    found = {r.page_id: r for r in out}
    for i, (_, want) in enumerate(CASES):
        assert found[i].text == want, i
    assert found[None].text == CASES[0][1]
    assert found[50].text == found[51].text == found[52].text == ""
    assert all(r.n_chars == len(r.text) for r in out)


def test_best_stretch_equals_brute_force():
    for scores in itertools.product((-2.0, -1.0, 0.0, 1.5, 3.0), repeat=5):
        spans = [(sum(scores[a:b]), a, b) for a in range(5) for b in range(a + 1, 6)]
        a, b = html.best_stretch(list(scores))
        assert sum(scores[a:b]) == max(0.0, *(s for s, *_ in spans))


def test_empty_table(spark):
    assert html.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_page(spark):
    body = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    weight = html.fit(pages(spark))
    assert html.main_text(page(body), weight) == " ".join([LONG] * 5000)


@pytest.fixture(scope="module")
def weight(spark):
    """Fitted on pages whose articles hold nothing but paragraphs, so that lists, tables and the like score low."""
    return html.fit(pages(spark))


COMMENT = "<section id=comments><h3>2 comments</h3><article class=comment-body><p>First! a nice read, thanks a lot for this</p></article><article class='comment even'><p>I disagree with all of it, sorry</p></article></section>"
KEPT = [
    ("<h2>A heading</h2>", "A heading"),
    ("<ul><li>one item<li>another <b>item</b></ul>", "one item another item"),
    ("<table><tr><th>Year<th>Sum<tr><td>1999</td><td>12</td></tr></table>", "Year Sum 1999 12"),
    ("<blockquote>They said so</blockquote>", "They said so"),
    ("<pre><span class='hljs-comment'># sum</span>\n  a = b &lt; c</pre>", "# sum a = b < c"),
    ("<p title='a > b' class=lead>quoted &amp; led</p>", "quoted & led"),
    ("<figure><img src=x><figcaption>A picture</figcaption></figure>", "A picture"),
    ("<dl><dt>Term<dd>Its meaning</dl>", "Term Its meaning"),
    ("<div>bare text<div>nested</div>after</div>", "bare text nested after"),
    (f"<p>{LONG}</p>", LONG),
    ("<p>see <a href=/x>this link</a>, too", "see this link , too".replace(" ,", ",")),
]
DROPPED = [
    "<aside class=related><article><h4>Read this too</h4><p>A teaser of another story, as long as you like</p></article></aside>",
    COMMENT, "<p class=advert>Buy one now</p>", "<p class='share-buttons'>Tell your friends</p>", "<button>Copy it</button>", "<form><label>Your mail</label><input name=x>Send</form>",
    "<script>var a = '<p>no</p>';</script>", "<div class='cookie-notice'>We bake</div>", "<nav><ul><li><a href=/>Home</a></ul></nav>", "<style>p{}</style>", "<!-- <p>no</p> -->",
    "<div class=newsletter-signup><p>Sign up for mail</p></div>", "<footer>Filed under words</footer>", "<div role=complementary>Seen elsewhere</div>", "<span class=ad>Sale</span>",
]
SHELLS = [
    "<article>{}</article>", "<main><article class='post tags-ai type-post'>{}</article></main>", "<div class='main-content header-story'><article>{}</article></div>", "<div class='page has-sidebar'><main>{}</main></div>",
    "<div class='post tags-ai'><h1>Top</h1>{}</div>", "<form id=aspnet><div itemprop='articleBody'>{}</div></form>", "<div class=layout-sidebar><main>{}</main></div>",
]


def test_every_block_of_the_article_and_no_frame(weight):
    """Pages built from parts whose place is known: the text must be that of the kept parts, in order."""
    r = random.Random(4)
    for i in range(300):
        parts = [("", f"<p>{LONG} {i}</p>", f"{LONG} {i}")]
        parts += [("", *r.choice(KEPT)) for _ in range(r.randint(0, 6))] + [("x", r.choice(DROPPED), "") for _ in range(r.randint(0, 4))]
        r.shuffle(parts)
        shell = r.choice(SHELLS)
        body = "".join(p for _, p, _ in parts)
        want = " ".join([*(["Top"] if "Top" in shell else []), *(t for _, _, t in parts if t)])
        assert html.main_text(page(shell.format(body) + r.choice(["", COMMENT])), weight) == want, (shell, body)


def test_parts_that_stood_out_before(weight):
    text = lambda body: html.main_text(page(body), weight)
    assert text(f"<article><header><h1>Title</h1><p>By someone</p></header><p>{LONG}</p></article>") == f"Title {LONG}"
    assert text(f"<header><h1>Site</h1></header><article><p>{LONG}</p></article>") == LONG
    assert text(f"<div class=wrap><div id=text><h2>Head</h2><ul><li>a<li>b</ul><p>{LONG}</p><p>{LONG}</p></div>{COMMENT}</div>") == f"Head a b {LONG} {LONG}"
    assert text("<article><h1>Only</h1><p><b>Few words.<br></article>") == "Only Few words."
    assert text(f"<article><p>one <svg viewBox='0 0'/> two</p><p>{LONG}</article>") == f"one two {LONG}"
    assert text(f"<article><p class=\"broken>{LONG}</p><p>{LONG}</article>") in (LONG, f"{LONG} {LONG}")


def test_sections_under_class_words_are_judged_by_their_score(weight):
    """A section of the article stays, whatever its class, if its text says so; a box of few words, links or a form does not."""
    text = lambda part, shell="article": html.main_text(page(f"<{shell}><p>{LONG}</p>{part}<p>{LONG} z</p></{shell}>"), weight)
    own = f"<h2>How it works</h2><p>{LONG} a</p><p>{LONG} b</p>"
    for name in ("login", "cookie-recipes", "share"):
        for tag in ("section", "div"):
            assert text(f"<{tag} class='{name}'>{own}</{tag}>") == f"{LONG} How it works {LONG} a {LONG} b {LONG} z"
    inner = "<div class=ad>Buy now</div><button>Go</button>"
    assert text(f"<section class=login>{own}{inner}</section>") == f"{LONG} How it works {LONG} a {LONG} b {LONG} z"
    boxes = [
        f"<section class=login><p>{LONG} a</p><p>{LONG} b</p></section>", "<section class=login><h2>Log in</h2><form><p>Your name and your word</p></form></section>",
        "<div class=newsletter><h3>Letters</h3><p>Get all of our news by mail, once a week, for free</p></div>",
        "<div class=sidebar><h3>Topics</h3><ul>" + "<li><a href=/>a topic</a></li>" * 4 + "</ul></div>", f"<section class=comments>{own}</section>", f"<aside>{own}</aside>",
    ]
    for box in boxes:
        assert text(box) == f"{LONG} {LONG} z", box
    # Without its weights nothing is pardoned: the fitted scores decide, not the lists alone.
    assert html.main_text(page(f"<article><p>{LONG}</p><section class=login>{own}</section></article>"), {**weight, "word@p": -1.0}) != f"{LONG} How it works {LONG} a {LONG} b"


def test_the_stretch_chooses_where_several_regions_are_marked(weight, monkeypatch):
    """Of several marked articles, or on a page without marks, the whole page in place of the stretch gives another text."""
    teasers = "<div class=list>" + "".join(f"<div>link list {i}</div>" * 3 for i in range(12)) + "</div>"
    unmarked = page(f"<div class=wrap><div id=text><p>{LONG}</p><p>{LONG}</p></div></div>{teasers}")
    right = html.main_text(unmarked, weight)
    assert right == f"{LONG} {LONG}"
    monkeypatch.setattr(html, "best_stretch", lambda scores: (0, len(scores)))
    assert html.main_text(unmarked, weight) != right


def test_null_repeated_and_tied_pages(spark, weight):
    """Of two stretches of one score the first is taken; repeated rows give one row each."""
    twice = f"<div><p>{LONG} a</p></div>" + "<nav>" + "<a href=/>menu words</a> " * 80 + "</nav>" + f"<div><p>{LONG} b</p></div>"
    assert html.main_text(page(twice), weight).startswith(f"{LONG} a")
    docs = spark.createDataFrame([(1, "u", page(twice))] * 3 + [(1, None, None)], SCHEMA)
    assert [len(r.text) > 0 for r in html.extract(docs, weight).orderBy(F.desc("n_chars")).collect()] == [True, True, True, False]
