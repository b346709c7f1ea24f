"""Main text of pages of several layouts."""

import re

import pytest

from logrisk.llm import html_text

LONG = "Words of the article that go on for quite a while, and some more of them. " * 4
LONG = LONG.strip()

LAYOUTS = {
    "article": f"<body><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></article><footer>Foot</footer>",
    "divs": f"<body><div class=top><a href=/>Home</a> <a href=/>B</a></div><div id=content><h1>Title</h1><p>{LONG}</p>"
    f"<p>{LONG}</p></div><div class='side-bar sidebar'><p>{LONG}</p></div><div id=footer>Some foot</div></body>",
    "sections": f"<body><div id=x><h1>Title</h1><div class=s><p>{LONG}</p></div><div class=s><p>{LONG}</p></div></div>"
    "<ul><li><a href=/>One</a><li><a href=/>Two</a></ul></body>",
    "noise inside": f"<main><article><header><h1>Title</h1></header><p>{LONG}</p><div class=ad><p>Buy now {LONG}</p></div><p>{LONG}</p>"
    f"<section id=comments><p>{LONG} says a reader</p></section><form><p>{LONG}</p></form></article></main>",
    "cookie": f"<body><div class=cookie-notice><p>{LONG} cookies</p></div><div class=post><h1>Title</h1><p>{LONG}<p>{LONG}</div>",
    "wrapper name": f"<body><div id='page-with-sidebar'><article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></article></div>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    assert html_text.main_text(LAYOUTS[name]) == f"Title\n\n{LONG}\n\n{LONG}"


LINKS = "<ul>" + "".join(f"<li><a href=/{i}>Another page {i}</a></li>" for i in range(12)) + "</ul>"
PART = f"<h2>Part</h2><p>{LONG}</p><p>{LONG}</p>"
ONE, TWO = f"Title\n\n{LONG}\n\n{LONG}", f"Part\n\n{LONG}\n\n{LONG}"
START = f"<h1>Title</h1><p>{LONG}</p><p>{LONG}</p>"

PARTS = {
    "articles in main": (f"<main><article>{START}</article><article>{PART}</article></main>", f"{ONE}\n\n{TWO}"),
    "articles in sections": (
        f"<main><section><article>{START}</article></section><section><article>{PART}</article></section></main>",
        f"{ONE}\n\n{TWO}",
    ),
    "articles in body": (f"<body><article>{START}</article><article>{PART}</article><div>Foot</div></body>", f"{ONE}\n\n{TWO}"),
    "teaser": (f"<main><article>{START}</article><article><a href=/>More</a> <a href=/>Most</a></article></main>", ONE),
    "link list": (f"<article>{START}{LINKS}</article>", ONE),
    "list of text": (f"<article>{START}<ul><li>One <a href=/>x</a> of the points<li>Two</ul></article>", f"{ONE}\n\nOne x of the points\n\nTwo"),
    "page in a form": (
        f"<body><form id=aspnetForm><input name=q><nav>Menu</nav><div>{START}</div><button>Send</button></form></body>",
        ONE,
    ),
    "article in a form": (f"<body><form><select><option>A</select><article>{START}</article></form></body>", ONE),
    "page in a named element": (f"<body><div class=overlay-page><div>{START}</div></div></body>", ONE),
    "long comments": (f"<body><div id=post>{START}</div><div id=comments>{f'<p>{LONG} so</p>' * 9}</div></body>", ONE),
    "side box in main": (
        f"<main><div>{START}</div><div><p>Weather today: sunny.</p><p>Wind: <a href=/>more</a></p></div></main><p>Outside</p>",
        ONE,
    ),
    "title beside the text in main": (
        f"<body><main><h1>Title</h1><div><p>{LONG}</p><p>{LONG}</p></div><div><a href=/>A</a> <a href=/>B</a></div></main></body>",
        ONE,
    ),
    "sections of main": (f"<main><section>{START}</section><section>{PART}</section><div>Share this</div></main>", f"{ONE}\n\n{TWO}"),
    "paragraphs of main": (f"<main>{START}<p>Short.</p></main><div>Foot</div>", f"{ONE}\n\nShort."),
    "names of sections": (
        f"<article>{START}<section id=discussion>{PART}</section><h2 id=related-work>Other</h2><h2 id=search>Third</h2></article>",
        f"{ONE}\n\n{TWO}\n\nOther\n\nThird",
    ),
}


@pytest.mark.parametrize("name", PARTS)
def test_parts_of_articles(name):
    page, expected = PARTS[name]
    assert html_text.main_text(page) == expected


def test_blocks_and_references():
    page = "<article><p>a&amp;b  <b>c</b>d<br>e&nbsp;&#233;\n f<p>g<!-- no --><script>x='</p>'</script><ul><li>h<li>i</ul>tail</article>"
    assert html_text.main_text(page) == "a&b cd e é f\n\ng\n\nh\n\ni\n\ntail"


@pytest.mark.parametrize("page", [None, "", " ", "<p>", "<html><head><title>x</title></head>", "<!--", "<nav>x</nav>"])
def test_nothing(page):
    assert html_text.main_text(page) == ""


def test_broken_and_deep_pages():
    assert html_text.main_text("plain text") == "plain text"
    assert html_text.main_text("</div></p><article>x</b></i><p>y") == "x\n\ny"
    assert html_text.main_text("<div>" * 50_000 + "deep") == "deep"
    assert len(html_text.main_text("<article>" + "<p>word word</p>" * 50_000)) == 50_000 * 11 - 2


def test_given_pages(spark, sf_dir):
    """The pages' articles hold paragraphs only: brute force is the element's own text."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = {row.page_id: row.html for row in pages.collect()}
    import html as entities

    for row in html_text.extract(pages).collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", html[row.page_id], re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert row.text == "\n\n".join(b for b in blocks if b)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(None, None, None, 1), (1, "u", "<p>x", 2), (1, "u", "<p>x", 2)], "page_id long, url string, html string, text int")
    assert sorted(r.text for r in html_text.extract(pages).collect()) == ["", "x", "x"]
    assert html_text.extract(pages.limit(0)).collect() == []
