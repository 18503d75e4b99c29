import html
import re

import numpy as np

from marklens.llm import wrappers
from marklens.llm.markup import read

LAYOUT = """<!doctype html><html><head><title>t{n}</title><style>p{{}}</style></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href=/>Home</a></li><li>About</li></ul></nav>
<div class="cookie-notice">We use cookies</div>{extra}
<div class="content-wrap"><h1>Title {n}</h1><div class="ad">Buy now</div>
<p>First   paragraph {n} &amp; more<br>goes on.<p>Second <b>bold</b> {n} &lt;x&gt;
<ul><li>point one<li>point two</ul>
<form><input><p>Your mail</p></form><script>if (a < b) document.write("<p>no</p>");</script></div>
<div id="comments"><p>Nice article {n}!</p></div><aside>Related {n}</aside>
<footer>&copy; 2024</footer></body></html>"""


def wanted(n):
    return "\n\n".join(
        [
            f"Title {n}",
            f"First paragraph {n} & more goes on.",
            f"Second bold {n} <x>",
            "point one",
            "point two",
        ]
    )


def texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in wrappers.extract(pages).collect()}


def test_layout_without_an_article_element(spark):
    rows = [
        (n, f"http://h.example/{n}", LAYOUT.format(n=n, extra="<div class=promo>x</div>" * (n % 2)))
        for n in range(6)
    ]
    assert texts(spark, rows) == {n: wanted(n) for n in range(6)}


def test_pages_of_the_tables(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in wrappers.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", inner)
        clean = [html.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))) for p in parts]
        blocks = [" ".join(c.split()) for c in clean]
        assert got[r["page_id"]] == "\n\n".join(b for b in blocks if b)


def test_alignment_makes_optional_repeated_and_text_slots():
    a = wrappers.page_wrapper(read("<body><h1>one</h1><p>a</p><p>b</p><table><tr><td>z</table></body>"))
    b = wrappers.page_wrapper(read("<body><h1>two</h1><p>c</p></body>"))
    whole = wrappers.expression(wrappers.align(a, b))
    assert whole == "<><body><h1>#</>(<p>#</>)+(<table><tr><td>z</></></>)?</></>"
    assert wrappers.expression(wrappers.align(b, a)) == whole


def test_broken_and_missing_pages(spark):
    rows = [
        (1, None, None),
        (2, "no address", ""),
        (3, "http://h.example/3", "just text <3 & more"),
        (4, "http://h.example/4", "<article><p>cut off &am"),
        (5, "http://h.example/5", "<article><p>a</article></p></div><p>b"),
        (6, "http://h.example/6", "<p" + " a='" * 50),
        (6, "http://h.example/6", "<p" + " a='" * 50),
        (7, "http://g.example/7", "<article><p>" + "long word " * 50_000 + "</p></article>"),
    ]
    got = texts(spark, rows)
    assert got[1] == got[2] == got[6] == ""
    assert got[3] == "just text <3 & more"
    assert got[4] == "cut off &am" and got[5] == "a"
    assert len(got[7]) == 50_000 * 10 - 1
    assert texts(spark, rows[:0] or [(0, None, None)]) == {0: ""}


def story(n):
    return f"Story {n} tells of number {n * 7}.", f"It ends with {n * 3} and nothing more to say."


def on_host(spark, body, pages=30):
    """Texts of a host's pages; ``body`` takes the number and the two paragraphs."""
    rows = [(n, f"http://h.example/{n}", f"<body>{body(n, *story(n))}</body>") for n in range(pages)]
    return texts(spark, rows)


def test_class_words_do_not_remove_the_layout(spark):
    got = on_host(spark, lambda n, a, b: f'<div class="layout no-sidebar"><div class=t><p>{a}<p>{b}</div></div>')
    assert got == {n: "\n\n".join(story(n)) for n in range(30)}


def test_teasers_do_not_replace_the_story(spark):
    got = on_host(
        spark,
        lambda n, a, b: f"<main><p>{a}<p>{b}<section><article class=card><p>Teaser {n}</article></section></main>",
    )
    assert got == {n: "\n\n".join(story(n)) for n in range(30)}


def test_all_articles_and_titles_stay(spark):
    got = on_host(spark, lambda n, a, b: f"<article class=x><p>{a}</article><article class=y><p>{b}</article>")
    assert got == {n: "\n\n".join(story(n)) for n in range(30)}
    got = on_host(spark, lambda n, a, b: f"<main><h1>{a}</h1><article><p>{b}</article></main>")
    assert got == {n: "\n\n".join(story(n)) for n in range(30)}
    got = on_host(spark, lambda n, a, b: f"<h1>{a}</h1><div><article><p>{b}</article></div>", 3)
    assert got == {n: "\n\n".join(story(n)) for n in range(3)}


def test_siblings_without_article_stay(spark):
    got = on_host(spark, lambda n, a, b: f"<h1>T {n}</h1><div class=lead>{a}</div><div class=story>{b}{b}</div>", 2)
    assert got == {n: "\n\n".join((f"T {n}", story(n)[0], story(n)[1] * 2)) for n in range(2)}


def test_constants_of_a_host_are_no_main_text(spark):
    legal = "All texts of this site may be read."
    for place in ("<p>{}", "<div class=z>{}</div>"):
        line = place.format(legal)
        got = on_host(spark, lambda n, a, b, line=line: f"<article><p>{a}<p>{b}{line}</article>")
        assert got == {n: "\n\n".join(story(n)) for n in range(30)}
    # On few pages, or on copies of one page, nothing tells them from the story.
    got = on_host(spark, lambda n, a, b: f"<article><p>{a}<p>{legal}</article>", 3)
    assert got == {n: f"{story(n)[0]}\n\n{legal}" for n in range(3)}
    got = on_host(spark, lambda n, a, b: f"<article><p>{story(1)[0]}<p>{legal}</article>")
    assert got == {n: f"{story(1)[0]}\n\n{legal}" for n in range(30)}


def test_reader_comments_go_however_long(spark):
    got = on_host(
        spark,
        lambda n, a, b: f"<article><p>{a}<p>{b}<div class=comments><article><p>{'I think so. ' * 50}{n}</article></div></article>",
    )
    assert got == {n: "\n\n".join(story(n)) for n in range(30)}


def test_deep_and_wide_pages(spark):
    deep = "<div>" * 5_000 + "<p>In the middle {}" + "</div>" * 5_000
    wide = "".join(f"<h2>Part {i} of {{0}}</h2><p>Text {i}</p>" for i in range(2_500))
    got = texts(
        spark,
        [(n, "http://deep.example/", deep.format(n)) for n in range(3)]
        + [(n, "http://wide.example/", wide.format(n) + "<ul><li>end</ul>" * (n % 2)) for n in range(10, 13)],
    )
    assert all(got[n] == f"In the middle {n}" for n in range(3))
    for n in range(10, 13):
        blocks = [x for i in range(2_500) for x in (f"Part {i} of {n}", f"Text {i}")]
        assert got[n] == "\n\n".join(blocks + ["end"] * (n % 2))


def test_common_places_are_a_longest_subsequence():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = (rng.integers(0, 4, rng.integers(0, 25)) for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                same = best[i, j] + 1 if a[i] == b[j] else 0
                best[i + 1, j + 1] = max(same, best[i, j + 1], best[i + 1, j])
        got = wrappers.common_places(a, b)
        assert len(got) == best[-1, -1]
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


def test_empty_table_and_other_columns(spark):
    schema = "page_id long, url string, html string, host string, wrapper string, text string"
    assert wrappers.extract(spark.createDataFrame([], schema)).collect() == []
    row = (1, "http://h.example/", "<article><p>Body</article>", "x", "y", "z")
    assert [tuple(r) for r in wrappers.extract(spark.createDataFrame([row], schema)).collect()] == [
        (1, "http://h.example/", "Body")
    ]
