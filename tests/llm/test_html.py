import pytest

import itertools
import math

from decklight.llm.html_tree import LABELLED_PAGES, extract, fit, main_text, marked_states, parse

SCHEMA = "page_id long, url string, html string, text string, n_chars int"

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href="/x">x</a></li></ul></nav>'
    '<!-- ad --><div class="ad">Buy.</div><article><h1>Head &amp; more</h1><p><b>One.<br><p>Two  &lt;three&gt;\n four</p><p>a<i>b</i>c</p></article>'
    "<footer>&copy; us</footer></body></html>"
)


def test_pages():
    model = fit([PAGE] * 20)
    assert main_text(PAGE, model) == "Head & more\nOne.\nTwo <three> four\nabc"
    for page in LABELLED_PAGES:
        kept = [n.text for n in parse(page) if n.text and n.text.startswith("+")]
        assert main_text(page, model).split("\n") == kept
    cut = PAGE[: PAGE.index("four")] + "&am"
    assert main_text(cut, model) == "Head & more\nOne.\nTwo <three> &am"
    assert main_text(cut + "<b cl", model) == "Head & more\nOne.\nTwo <three> &am"
    assert main_text("", model) == main_text("<nav><a>x</a></nav>", model) == ""


def test_nothing_is_lost_after_odd_markup():
    model, para = fit([PAGE] * 20), f"<p>{(second := ' '.join(['The second paragraph of the article has a good many words in it.'] * 4))}</p>"
    for odd in (
        '<svg viewBox="0 0 1 1"/>', "<svg><path d='M0'></svg>", "<math/>", "<button>Buy", "<button>Buy</button>", "<select><option>One", "<iframe src='x'>", "<iframe src='x'></iframe>",
        "<template><p>Not shown</p><template><p>Nor this</p></template><p>Nor that</p></template>", "<template>", "<noscript>", "<textarea>", "<script>var a = 1;", "<button>A<button>B</button>",
        "<svg><text>Not shown", "<xmp>", "<style>p{}", "<script>a</script>",
    ):
        page = f"<article><h1>Title of it</h1><p>The first paragraph is of some length as well.</p>{odd}{para}{para}</article><footer>Not shown</footer>"
        assert main_text(page, model) == "Title of it\nThe first paragraph is of some length as well.\n" + "\n".join([second] * 2), odd
    model = fit([PAGE, f"<body><nav><a>x</a></nav><article><h1>Title</h1>{para * 4}</article></body>"] * 20)
    for page in (
        f'<body><nav><a>x</a></nav><article class="post share-count">{para}</article></body>',
        f'<body><article>{para}<div class="related-work"><h2>Related work</h2>{para}{para}</div></article></body>',
    ):
        assert main_text(page, model).count(second) == page.count(para)


def test_deep_pages_take_linear_time():
    import time

    start = time.time()
    parse("<div>" * 20_000 + "</p></span>" * 20_000)
    parse("<b>" * 20_000 + "<p>x<li>y" * 5_000)
    parse("<script>" * 20_000)
    parse("<template>" * 20_000 + "<button>" * 20_000)
    assert time.time() - start < 5


def test_marginals_against_all_assignments():
    model = fit([])
    page = '<nav><a>x</a></nav><div><p>Some words of a text that go on.</p><div class="ad"><p>Buy</p></div></div>'
    nodes = parse(page)
    weights = [0.0] * len(nodes)
    total = 0.0
    for states in itertools.product((0, 1), repeat=len(nodes)):
        score = sum(model.unary(nodes, i)[s] for i, s in enumerate(states))
        score += sum(model.log_edge[n.text is not None][states[n.parent]][states[i]] for i, n in enumerate(nodes) if i)
        total += math.exp(score)
        for i, s in enumerate(states):
            weights[i] += s * math.exp(score)
    for p, w in zip(model.marginals(nodes), weights):
        assert abs(p - w / total) < 1e-9
    assert len(marked_states(nodes)) == len(nodes)


def test_rows(spark):
    rows = [(1, "u", PAGE, "x", 1), (1, "u", PAGE, "x", 1), (None, None, None, None, None), (2, "v", "", None, None), (3, "w", "<p>" + "word " * 100_000, None, None), (4, "y", "<" * 3000 + "'\"" * 99, None, None)]
    got = sorted(map(tuple, extract(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    text = "Head & more\nOne.\nTwo <three> four\nabc"
    assert got.count((1, "u", text, len(text))) == 2
    assert (None, None, "", 0) in got and (2, "v", "", 0) in got and len(got) == 6
    assert extract(spark.createDataFrame([], SCHEMA)).count() == 0


def in_article(body):
    return (
        "<body><nav><a>Home</a><a>News</a></nav><article><h1>Title here</h1><p>First words of the text, a few of them.</p>"
        f"{body}<p>The last paragraph of it.</p></article><footer>All rights</footer></body>"
    )


@pytest.mark.parametrize(
    ("body", "kept"),
    [
        ("<p title=it's>Middle one.</p><p>Another.</p><p title=he's>Third.</p>", ["Middle one.", "Another.", "Third."]),
        ("<!--><p>After it.</p>", ["After it."]),
        ("<!---><p>After it.</p>", ["After it."]),
        ("<!-- a > b --!><p>After it.</p>", ["After it."]),
        ("<![CDATA[ x ><p>After it.</p>", ["After it."]),
        ("<svg><![CDATA[ <p>no</p> ]]></svg><p>After it.</p>", ["After it."]),
        ('<p class="ad-free">Here there is no advertisement at all.</p>', ["Here there is no advertisement at all."]),
        ('<ul class="menu"><li>Soup of the day</li><li>Fish and rice</li></ul>', ["Soup of the day", "Fish and rice"]),
        ("<p data-x='a > b' title=\"c > d\">Quoted.</p>", ["Quoted."]),
        ("<p title=a'b>One.</p><p title='open>Two.</p>", ["One.", "Two."]),
        ('<div class="advert"><p>Buy a coat, it is a good one.</p></div>', []),
    ],
)
def test_article_text_is_not_lost(body, kept):
    wanted = "\n".join(["Title here", "First words of the text, a few of them.", *kept, "The last paragraph of it."])
    assert main_text(in_article(body), fit()) == wanted


def test_reader_comments_under_other_names_go():
    page = in_article("").replace("<footer>", '<div class="discussion"><p>I think that this is quite wrong, and said so before.</p></div><footer>')
    assert "quite wrong" not in main_text(page, fit())
