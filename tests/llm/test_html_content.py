"""Pages: exact marginals, the template's articles, odd markup."""

import html
import itertools
import math
import random
import re

import pytest

from panelspark.llm import html_content as H


@pytest.fixture(scope="module")
def model():
    return H.fit()


@pytest.mark.parametrize("seed", range(20))
def test_marginals_against_enumeration(seed):
    draw = random.Random(seed)
    n = draw.randint(1, 9)
    parents = [-1] + [draw.randrange(i) for i in range(1, n)]
    page = H.Page(parents, [[draw.randrange(4)] for _ in range(n)], [draw.randrange(3) for _ in range(n)], [0] * n, [])
    nodes = [draw.uniform(-3, 3) for _ in range(4)]
    edges = [[draw.uniform(-3, 3) for _ in range(4)] for _ in range(3)]
    found, pairs, log_partition = H.marginals(page, nodes, edges)
    total, single, double = 0.0, [0.0] * n, [[0.0] * 4 for _ in range(n)]
    for labels in itertools.product((0, 1), repeat=n):
        score = sum(nodes[page.features[i][0]] for i in range(n) if labels[i])
        score += sum(edges[page.kinds[i]][2 * labels[parents[i]] + labels[i]] for i in range(1, n))
        weight = math.exp(score)
        total += weight
        for i in range(n):
            single[i] += weight * labels[i]
            if i:
                double[i][2 * labels[parents[i]] + labels[i]] += weight
    assert math.log(total) == pytest.approx(log_partition)
    assert [x / total for x in single] == pytest.approx(found)
    for i in range(1, n):
        assert [x / total for x in double[i]] == pytest.approx(list(pairs[i]))


def test_labelled_pages_are_learned(model):
    for source in H.LABELLED_PAGES:
        page = H.read_page(source)
        found, _, _ = H.marginals(page, model.nodes, model.edges)
        assert all((found[node] >= 0.5) == bool(page.labels[node]) for node, _ in page.runs)


def articles(source: str) -> str:
    """The article of the template of the tables' pages, by plain cutting."""
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", source, re.DOTALL)[1]
    blocks = (re.sub(r"</?b>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)\s*>", inner))
    return "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_pages(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = H.extract(pages, model).collect()
    assert len(rows) == pages.count()
    for row in rows:
        assert row["text"] == articles(row["html"])
        assert row["n_chars"] == len(row["text"])


def runs(source):
    return [t for _, t in H.read_page(source).runs]


def test_reading():
    assert runs("<p>a <b>b</b>\n c<br>d<p>e &amp; f&nbsp;g &am") == ["a b c d", "e & f g &am"]
    assert runs("x<!-- a > b --><script>var t='</p>';</script>y<STYLE>z</STYLE><title>t</title>") == ["xy"]
    assert runs("1 < 2 <p title=\"a>b\">q</p <p>") == ["1 < 2", "q"]
    assert runs("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>1<td>2<tr><td>3</table>z") == [*"abc123z"]
    assert runs("<form>in<textarea>no</textarea><button>no</button></form>") == ["in"]
    assert runs("") == runs("<p></p>") == runs("<!-- open") == runs("<p cla") == []


def test_odd_pages(spark, model):
    long = "<article>" + "<p>Some words, then more of them.</p>" * 20000 + "</article>"
    rows = [(1, None, None), (2, "u", ""), (3, "u", "plain text, no markup at all."), (4, "u", long), (4, "u", long),
            (5, "u", "<div>" * 5000 + "deep"), (None, "u", "<<<>>>&&&<p <b <a href='")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as Text", "1 as n_chars")
    found = H.extract(pages, model).collect()
    by = {r["page_id"]: r for r in found}
    assert len(found) == len(rows) and found[0].asDict().keys() >= {"text", "n_chars"}
    assert by[1]["text"] == by[2]["text"] == "" and by[1]["n_chars"] == 0
    assert by[4]["text"].count("\n\n") == 19999
    assert H.extract(pages.limit(0), model).count() == 0


@pytest.mark.parametrize("piece", ["<", "<p>", "<div>", "<a b=\"", "</p>", "<!--", "&", "<b>x", "<li>", "<p a='"])
def test_time_is_linear(model, piece):
    model.text(piece * 30000)


def test_hidden_elements_end():
    """Empty and unclosed hidden elements do not take the text after them."""
    for icon in ("<svg class='i' />", "<svg/>", "<math/>", "<svg><path d='M0'/><title/><g></svg>", "<svg><path></svg>"):
        assert runs(f"<article><p>one {icon}two</p><p>three</p></article>") == ["one two", "three"]
    assert runs("<div><p>a <svg><path d=''><p>b</div>c") == ["a", "b", "c"]
    assert runs("<p><a href=x><svg></a>b</p>c") == ["b", "c"]
    for tag in ("button", "select", "template", "svg", "datalist"):
        assert runs(f"<div><section>a<{tag}>no</section>b</div><p>c") == ["a", "b", "c"]
        assert runs(f"<div>a<{tag}><g>no</g>no</{tag}> b</div>c") == ["a b", "c"]
    assert runs("<div>a<button><div>no</div>no<button>no<svg/>no</button> b</div>c") == ["a b", "c"]
    assert runs("<svg><foreignObject><p>no</p></foreignObject></svg>a") == ["a"]
    assert runs("<head><meta a=b><title>no</title><style>no</style><p>a") == ["a"]


def test_formulas_and_stand_ins_are_left_to_the_model(model):
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>no</annotation></semantics></math>"
    assert runs(f"<p>so {formula} holds</p>") == ["so x=2 holds"]
    for tag in ("object", "audio", "video", "noscript", "canvas", "map"):
        assert runs(f"<p>a <{tag}><source src=x>b</{tag}> c</p>d") == ["a b c", "d"]
        assert runs(f"<p>a <{tag}> <img src=x> </{tag}>c</p>d") == ["a c", "d"]
        assert runs(f"<article><p>a<{tag}></p><p>b</article>c") == ["a", "b", "c"]
        plain = H.read_page("<div><p>a</p><p>b</p></div>c")
        assert H.read_page(f"<{tag}><img></{tag}><div><p>a<{tag}> </{tag}></p><p>b</p></div>c<{tag}>") == plain
        assert H.read_page(f"a<{tag}>b</{tag}>c").runs == [(0, "a"), (1, "b"), (0, "c")]
    text = "A long sentence of an article that says what there is to say, and then some more of the same."
    for tag in ("object", "audio", "video", "noscript"):
        inside = (f"<h1>On films</h1><p>{text} <{tag}>{text}</{tag}></p><{tag}>{text}</{tag}>"
                  f"<{tag}><p>{text}</p></{tag}><p>{text} {formula}</p>")  # fmt: skip
        found = model.text(f"<body><noscript>No scripts.</noscript><nav><a href=a>Home</a></nav><article>{inside}</article></body>")
        assert found.startswith("On films") and found.count(text) == 5 and found.endswith("x=2")


@pytest.mark.parametrize("piece", ["<svg>", "<video>", "<button><i></b>", "<template><b></i>", "<svg><p>", "<noscript>x"])
def test_time_of_hidden_elements_is_linear(model, piece):
    model.text("<div>" + piece * 30000 + "</p>" * 30000)


@pytest.mark.parametrize("comment", ["<!-->", "<!--->", "<!-- x --!>", "<!-- a > b -->", "<!---->"])
def test_comments_end_where_browsers_end_them(comment):
    page = f"<html><body><p>One two three.</p>{comment}<p>Four five six.</p><!-- open <p>gone"
    found = " ".join(text for _, text in H.read_page(page).runs)
    assert "One two three." in found and "Four five six." in found and "gone" not in found
