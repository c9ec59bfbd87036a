from collections import Counter

import hand_labelled
import pytest

from cellframe.llm import html_crf
from cellframe.llm.dom import blocks

SF = "/root/testdata/sf0.01"


def texts(html):
    return [b.text for b in blocks(html)]


@pytest.mark.parametrize("html, expected", [
    (None, []), ("", []), ("  \n ", []), ("plain", ["plain"]),
    ("<p>a<br>b</p>", ["a b"]), ("<p>a <b>b</b>c</p>", ["a bc"]),
    ("<p>a &amp; b &lt;c&gt; &#233;&nbsp;x</p>", ["a & b <c> é x"]),
    ("<p>one<p>two<li>three", ["one", "two", "three"]),
    ('<script>var t="</p>";</script><style>p{}</style><p>x</p>', ["x"]),
    ("<!-- <p>no</p> --><p>yes</p>", ["yes"]), ("<!-- open <p>no</p>", []),
    ('<p title="a > b">x</p>', ["x"]), ("1 < 2 and <b>3</b>", ["1 < 2 and 3"]),
    ("<p>x</div></b></p></p>y", ["x", "y"]), ("<P CLASS=A>x</P>", ["x"]),
    ("<p><b>a<br><p>b</p>", ["a", "b"]), ("a\n\t b", ["a b"]),
    ("<script>never closed <p>x</p>", []), ("<![CDATA[x]]><?php y ?>z", ["z"]),
])
def test_blocks(html, expected):
    assert texts(html) == expected


@pytest.mark.parametrize("icon", [
    '<svg class="i"/>', "<svg/>", '<SVG a="x > y" />', "<math display='block'/>",
    "<svg viewBox='0 0 1 1'><path d='M0'/>no</svg>", '<math><mi>no</mi></math >',
    '<svg-icon name="x"></svg-icon>', "<object-view></object-view>", "<svg:rect/>",
    "<style-guide a=b></style-guide>", "<math-field/>", "<script-x></script-x>",
    "<template-part>\n</template-part>", "<canvas\nid=c>no</canvas>",
])
def test_text_after_icons_and_custom_elements(icon):
    page = f"<article><p>one</p>{icon}<p>two</p><p>three</p></article>"
    assert texts(page) == ["one", "two", "three"]


def test_a_self_closed_icon_ends_no_block():
    assert texts("<p>one <svg class=i /> two</p>") == ["one two"]
    assert texts("<p>x</p><svg-icon>shown</svg-icon><p>y</p>") == ["x", "shown", "y"]
    assert texts('<script src="a"/>var x</script><p>x</p>') == ["x"]


def test_paths_and_links():
    found = blocks('<div class="main nav"><ul><li><a href=x>go</a> now</li></ul></div>')
    assert found[0].path == (("div", ("main", "nav")), ("ul", ()), ("li", ()))
    assert found[0].linked == 2


def test_viterbi_is_the_best_of_all():
    import itertools
    import random

    pick = random.Random(1)
    for _ in range(200):
        emit = [pick.uniform(-2, 2) for _ in range(pick.randint(1, 7))]
        start = (pick.uniform(-1, 1), pick.uniform(-1, 1))
        moves = tuple(tuple(pick.uniform(-1, 1) for _ in "ab") for _ in "ab")

        def score(labels):
            total = start[labels[0]] + sum(e for e, y in zip(emit, labels) if y)
            return total + sum(moves[a][b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=len(emit)), key=score)
        assert html_crf.viterbi(emit, start, moves) == list(best)


@pytest.fixture(scope="module")
def model(spark):
    return html_crf.train(spark.read.parquet(f"{SF}/pages.parquet"))


def test_landmarks_are_followed_and_variants_understood(spark, model):
    label = model.labeller()
    wrong = count = 0
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        page = blocks(r["html"])
        truth = html_crf.landmark_labels(page)
        assert label(page) == truth
        main = [b.text for b, y in zip(page, truth) if y]
        other = [b.text for b, y in zip(page, truth) if not y]
        again, marks = html_crf.variant(main, other, r["page_id"] + 10**6)
        parsed = blocks(again)
        assert len(parsed) == len(marks)
        wrong += sum(a != b for a, b in zip(label(parsed), marks))
        count += len(marks)
    assert wrong < 0.01 * count


def test_without_landmarks(model):
    words = "Some longer sentence of the story, with a few more words. " * 4
    page = blocks(
        "<body><div class='menu'><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul>"
        f"</div><div class='content'><h1>A title</h1><p>{words}</p><div class='ad'>Buy now</div>"
        f"<p>{words}</p></div><div class='comments'><div class='comment'><p>{words}</p></div></div>"
        "<div class='footer'>&copy; me</div></body>"
    )
    kept = [b.text for b, y in zip(page, model.labeller()(page)) if y]
    assert kept == ["A title", words.strip(), words.strip()]


def test_pages(spark, model):
    rows = [(1, "u", None, "c"), (2, None, "", "c"), (None, "u", "<article><p>x y z.</p></article>", "c"),
            (3, "u", "<article>" + "<p>Some words here, more.</p>" * 3000 + "</article>", "c")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_crf.extract(pages, model).collect()
    assert len(got) == 8
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == "" == by[2]["text"] and by[1]["n_chars"] == 0
    assert by[3]["n_main"] == 3000 and by[3]["n_chars"] == len(by[3]["text"])
    assert html_crf.extract(pages.limit(0), model).count() == 0


def test_no_page_to_learn_from(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    model = html_crf.train(empty)
    pages = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string")
    assert html_crf.extract(pages, model).count() == 1


@pytest.mark.parametrize("name, html, count", [
    ("odd quotes", '<p title="x>y</p>' * 50_000 + '"', None),
    ("quotes that never close", '<a "' * 50_001, 1),
    ("deep", "<div>" * 100_000 + "x", 1),
    ("deep, all different", "".join(f"<div class=c{'abcdefghij'[i % 10] * (i // 10)}>" for i in range(2000)) + "x", 1),
    ("inline ones never closed", "<b>" * 50_000 + "<li>x</li>" * 50_000, 50_000),
    ("ends without starts", "</p>" * 100_000 + "<!x " * 100_000, 0),
])
def test_linear_time(model, name, html, count):
    import time

    began = time.process_time()
    page = blocks(html)
    labels = model.labeller()(page)
    html_crf.landmark_labels(page)
    assert time.process_time() - began < 20 and len(labels) == len(page)
    assert count is None or len(page) == count


def test_a_tag_without_an_end_is_text():
    assert texts('<p>a <b "c</p>') == ['a <b "c']
    assert texts("<p>a</p><p title='x>b</p><i>c</i>") == ["a", "<p title='x>b", "c"]


@pytest.mark.parametrize("without", [False, True])
def test_a_table_without_landmarks(spark, without):
    """Articles are found also when no page of the table says where they are."""
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    strip = lambda h: re.sub(r"<(/?)(article|main)\b", r"<\1div", h)
    rows = [(r["page_id"], r["url"], strip(r["html"]) if without else r["html"], 1) for r in pages]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, chosen_id int")
    found = {r["page_id"]: r["text"].split() for r in html_crf.extract(table, html_crf.train(table)).collect()}
    right = wrong = missed = 0
    for r in pages:
        page = blocks(r["html"])
        truth = html_crf.landmark_labels(page)
        main = " ".join(b.text for b, y in zip(page, truth) if y).split()
        hit = sum((Counter(main) & Counter(found[r["page_id"]])).values())
        right, wrong = right + hit, wrong + len(found[r["page_id"]]) - hit
        missed += len(main) - hit
    assert wrong <= 0.02 * right and missed <= 0.05 * right


def test_pages_labelled_by_hand(model):
    right = wrong = missed = 0
    for html, text in hand_labelled.PAGES:
        page = blocks(html)
        got = " ".join(b.text for b, y in zip(page, model.labeller()(page)) if y).split()
        hit = sum((Counter(got) & Counter(text.split())).values())
        right, wrong, missed = right + hit, wrong + len(got) - hit, missed + len(text.split()) - hit
    assert wrong <= 0.1 * right and missed <= 0.1 * right, (right, wrong, missed)


def test_the_sample_is_bounded(spark):
    rows = [(1, "u", f"<main><p>text {i % 5}</p></main>") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen = []
    plain_fit, html_crf.fit = html_crf.fit, lambda found: seen.append(len(found)) or plain_fit(found)
    try:
        html_crf.train(pages)
    finally:
        html_crf.fit = plain_fit
    assert seen[0] <= 1 + html_crf.VARIANTS
