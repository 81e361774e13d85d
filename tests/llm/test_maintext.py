import pytest

from siftwell.llm import maintext


@pytest.fixture(scope="module")
def tree(spark):
    return maintext.train(spark)


def page(body):
    return f"<!DOCTYPE html><html><head><title>T t</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


ARTICLE = "<h1>Head</h1><p><b>One &amp; two</b> three\n  four<br>five<p>Six.</p><p>a &lt; b &#x41;&eacute;</p>"
TEXT = "Head One & two three four five Six. a < b Aé"


@pytest.mark.parametrize(
    "around",
    [
        "{}",
        '<nav><ul><li><a href="/x">Home</a></li></ul></nav><div class="ad">Buy this now please all of you</div>{}<footer>&copy; x</footer>',
        '<header><h1>Site name</h1></header><aside><p>Some words about other things that are long enough to look like text here</p></aside>{}',
        '{}<section id="comments"><article><p>I think this is a very good article and I like it.</p></article></section>',
        '<div class="cookie-notice">We use cookies on this site and you have to agree with all of them</div>{}<form><p>Your name here</p></form>',
        '<!-- <p>not this</p> --><div class="sideBar"><p>Other things to read on this site today</p></div>{}<script>"<p>x</p>"',
        '<div class="layout has-sidebar"><form id="page">{}</form><div class="sidebar"><p>More things to read on this site</p></div></div>',
        '<header><p>A site about things that are nice to read about</p>{}</header><form><p>Please write your name and address here</p></form>',
        '<div role="navigation"><p>a b c</p></div><table class="widget"><tr><td>1</td></tr></table>{}<dialog>Sign in</dialog>',
    ],
)
def test_article_without_the_rest(tree, around):
    assert maintext.main_text(page(around.format(f"<article>{ARTICLE}</article>")), tree) == TEXT


def test_page_without_article(tree):
    long = "many words follow here and they go on for quite a while so that this is a paragraph " * 3
    body = f'<div><a href="/">Home</a></div><div><a href="/b">B</a></div><div><p>{long}</p><p>{long}</p></div><div><a href="/c">C c</a></div>'
    assert maintext.main_text(page(body), tree) == " ".join([long.strip()] * 2)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<article>", ""), ("<article><p>a", "a"), ("<article><p>a &am", "a &am"), ("<article><p>a</p", "a"),
        ("<article><p>1 < 2 > 0</p></article>", "1 < 2 > 0"), ("<article><p title='a>b'>x</p>", "x"), ("<article><p>a<script>b", "a"),
        ("<ARTICLE><P>a<BR/>b</P></ARTICLE>", "a b"), ("<article><p>a<!-- x", "a"), ("<article>" + "<p>w</p>" * 20_000, " ".join(["w"] * 20_000)),
    ],
)
def test_hard_pages(tree, html, text):
    assert maintext.main_text(html, tree) == text


def test_extract_table(spark, tree):
    rows = [(1, "u", page(f"<article>{ARTICLE}</article>"), "z"), (1, "u", None, "z"), (None, None, "", "z")]
    got = maintext.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), tree)
    assert sorted(map(str, got.collect())) == sorted(
        [f"Row(page_id=1, url='u', text={TEXT!r})", "Row(page_id=1, url='u', text='')", "Row(page_id=None, url=None, text='')"]
    )
    assert maintext.extract(spark.createDataFrame([], "page_id long, url string, html string"), tree).count() == 0


WORDS = " ".join(f"word{i}" for i in range(60))


def site(body: str) -> str:
    menu = "<nav><a href=/>Home</a> <a href=/a>News</a></nav>"
    return f"<html><body>{menu}{body}<footer><a href=/i>Imprint</a></footer></body></html>"


@pytest.mark.parametrize(
    "body, text",
    [
        (f"<article><p>{WORDS}</p><p>A short last line.</p></article><p><a href=/x>More</a></p>", f"{WORDS} A short last line."),
        (f"<article><header class=\"entry-header\"><h1>Title of it</h1></header><p>{WORDS}</p></article>", f"Title of it {WORDS}"),
        (f"<div class=\"no-sidebar\"><p>{WORDS}</p></div>", WORDS),
        (f"<article><p class=\"market-share\">{WORDS}</p></article>", WORDS),
        (f"<article><p>{WORDS}</p><figure><img src=a><figcaption>What it shows</figcaption></figure><p>{WORDS}</p></article>", f"{WORDS} What it shows {WORDS}"),
        (f"<article><p>{WORDS} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then</p></article>", f"{WORDS} x=2 then"),
        (f"<article><p>{WORDS}</p><div class=\"post-share\">Share it</div><div id=siteSearch>Find</div></article>", WORDS),
        (f"<article><p>{WORDS}</p></article><div class=\"comments-header\"><p>{WORDS}</p></div>", WORDS),
    ],
)
def test_what_belongs_to_an_article(tree, body, text):
    assert maintext.main_text(site(body), tree) == text
