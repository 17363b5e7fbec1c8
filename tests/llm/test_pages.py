import html
import random
import re

import pytest

from faremill.llm import pages, queries

SCHEMA = "page_id long, url string, html string, host string, text string"


def shell(i, body, notice="Read our terms."):
    return (
        f"<html><head><title>t{i}</title><style>p{{}}</style></head><body>"
        f"<div><p>Site of the town</p></div><nav><a href=/>home</a></nav>"
        f"<div class='cookie-notice'>We use cookies {i}</div>{body}"
        f"<div><p>{notice}</p></div><aside>side {i}</aside><form><p>Join</p></form>"
        f"<section id=comments><p>first! {i}</p></section><footer>end {i}</footer></body></html>"
    )


def made(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA).repartition(3)


def texts(frame):
    return {r.page_id: r.text for r in frame.collect()}


def test_template_is_told_from_slots_without_an_article_element(spark):
    rows = [
        (i, f"http://a.example/{i}", shell(i, f"<div><p>Story {i} begins &amp; ends.</p><p>Part\n two {i}</p></div>"))
        for i in range(6)
    ]
    found = texts(pages.extract(made(spark, rows)))
    assert found == {i: f"Story {i} begins & ends.\nPart two {i}" for i in range(6)}


def test_article_and_awkward_markup(spark):
    article = "<article><header><h1>Head &eacute;</h1></header><p>One<p>Two<br>lines <b>bold</b> x<i>y</i><ul><li>a<li>b</ul><script>var p='<p>';</script><div class=ad>Buy</div>"
    rows = [
        (1, "http://b.example/1", shell(1, article + "</article>")),
        (2, None, shell(2, article + "</article>")),
        (3, "not a url", f"<body>{article}<p>cut &am"),
        (4, "http://c.example/", None),
        (5, "http://c.example/", ""),
        (6, "http://c.example/x", "plain words  only"),
        (7, "http://d.example/", "<div>" * 3000 + "deep" + "</div>" * 3000),
        (8, "http://d.example/y", "<article><p>whole</p></article>" + "<a href='"),
        (8, "http://d.example/y", "<article><p>whole</p></article>" + "<a href='"),
        (None, "http://e.example/", "<main><p>kept</p></main><p>not</p>"),
    ]
    found = texts(pages.extract(made(spark, rows)))
    whole = "Head é\nOne\nTwo lines bold xy\na\nb"
    assert found[1] == found[2] == whole and found[3] == whole + "\ncut &am"
    assert (found[4], found[5], found[6]) == ("", "", "plain words only")
    assert (found[7], found[8], found[None]) == ("deep", "whole", "kept")


def test_copies_of_one_article_keep_it(spark):
    body = "<article><h1>Same</h1><p>All of it is the same text.</p></article>"
    rows = [(i, f"http://m.example/{i}", shell(i % 3, body)) for i in range(5)]
    found = texts(pages.extract(made(spark, rows)))
    assert set(found.values()) == {"Same\nAll of it is the same text."}


def test_constant_line_inside_articles_is_template(spark):
    rows = [
        (i, f"http://s.example/{i}", f"<article><h1>T{i}</h1><p>Long and own text number {i} goes on here</p><p>Share this</p></article>")
        for i in range(8)
    ]
    found = texts(pages.extract(made(spark, rows)))
    assert found[3] == "T3\nLong and own text number 3 goes on here"


def test_tree_matching_counts_shared_nodes():
    a = pages.parse("<div><p>1</p><ul><li>x<li>y</ul><p>2</p></div>")
    b = pages.parse("<div><ul><li>z</ul><p>3</p></div>")
    n, pairs = pages.matched(a, b, pages.Wrapper())
    assert n == len(pairs) == 5  # root, div, ul, li, p
    n, _ = pages.matched(a, b, pages.Wrapper(cells=0))
    assert n >= 3


def test_empty_table(spark):
    assert pages.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/pages.parquet").collect()
    found = {r.page_id: r for r in queries.QUERIES["op8_wrapper_induction"](spark, small).collect()}
    for r in rows:
        inner = (r.html or "").partition("<article>")[2].partition("</article>")[0]
        inner = re.sub(r"<[^<>]*\Z", "", inner)
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split("</?(?:p|h1)>", inner)]
        expected = "\n".join(p for p in parts if p)
        assert found[r.page_id].text == expected and found[r.page_id].n_chars == len(expected)


@pytest.mark.parametrize("bad", ["<", "</", "<!--", "<p", "&", "&#x110000;", "<![CDATA[x", "<?php", "</p></p></p>"])
def test_broken_markup_does_not_crash(bad):
    assert isinstance(pages.main_text(f"<p>a</p>{bad}", None, pages.Wrapper()), str)


def test_every_host_with_two_unlike_pages_has_a_template(spark):
    rows = [
        (10 * h + i, f"http://h{h}.example/{i}", f"<article><h1>T{i} {h}</h1><p>Long and own text number {i} goes on here</p><p>Share this</p></article>")
        for h in range(12)
        for i in range(2)
    ]
    found = texts(pages.extract(made(spark, rows)))
    assert not [k for k, t in found.items() if "Share this" in t]


def test_copies_at_the_front_and_chance_passages_do_not_decide(spark):
    def page(i, passage=""):
        own = f"<p>Long and own text number {i} goes on here and on</p>"
        return f"<article><h1>T{i}</h1>{own}{passage}<p>Share this</p></article>"

    rows = [(i, f"http://p.example/{i}", page(0)) for i in range(12)]  # copies of least id
    rows += [(i, f"http://p.example/{i}", page(i)) for i in range(12, 40)]
    rows += [(i, f"http://q.example/{i}", page(i, "<p>Said twice</p>" if i < 104 else "")) for i in range(100, 120)]
    found = texts(pages.extract(made(spark, rows)))
    assert not [k for k, t in found.items() if "Share this" in t]
    assert all("Said twice" in found[i] for i in range(100, 104))


def test_long_articles_are_read_like_short_ones(spark):
    def page(i, n):
        own = "".join(f"<p>Own sentence {k} of page {i}</p>" for k in range(n + i))
        return f"<article><h1>T{i}</h1><p>Share this</p>{own}<p>The end</p></article>"

    for n in (3, 200):
        rows = [(i, f"http://l.example/{i}", page(i, n)) for i in range(4)]
        for i, text in texts(pages.extract(made(spark, rows))).items():
            assert text.split("\n") == [f"T{i}", *(f"Own sentence {k} of page {i}" for k in range(n + i))]


def test_cells_that_many_pages_share_are_no_template(spark):
    rows = [
        (i, f"http://c.example/{i}", f"<article><p>Own text of page {i} here</p><table><tr>{'<td>yes</td>' * (i + 1)}</tr></table></article>")
        for i in range(6)
    ]
    found = texts(pages.extract(made(spark, rows)))
    assert all(found[i].count("yes") == i + 1 for i in range(6))


def test_a_slot_with_an_unlucky_name_is_the_article(spark):
    rows = [
        (i, f"http://n.example/{i}", "<body><div><p>Daily Gazette of Town</p></div>"
         f"<div class='social-issues'><p>Story {i} of the council begins</p><p>and ends with vote {i}</p></div>"
         "<div class='social'><p>Follow me</p></div><div><p>All rights kept by us</p></div></body>")
        for i in range(6)
    ]
    found = texts(pages.extract(made(spark, rows)))
    assert found == {i: f"Story {i} of the council begins\nand ends with vote {i}" for i in range(6)}


def test_readers_comments_never_become_the_article(spark):
    rows = [
        (i, f"http://r.example/{i}", f"<body><div><p>Own short text {i}</p></div><div class='comment-list'>"
         + "".join(f"<p>reader {k} says much about {i}</p>" for k in range(9)) + "</div></body>")
        for i in range(5)
    ]
    assert texts(pages.extract(made(spark, rows))) == {i: f"Own short text {i}" for i in range(5)}


def test_a_constant_line_of_short_articles_is_template(spark):
    line = "Subscribe now for the best of our news every day"
    rows = [
        (i, f"http://t.example/{i}", f"<article><h1>Title {i}</h1><p>Short story {i}</p><p>{line}</p></article>")
        for i in range(6)
    ]
    assert texts(pages.extract(made(spark, rows))) == {i: f"Title {i}\nShort story {i}" for i in range(6)}


def test_a_host_is_dealt_to_several_groups(spark):
    rows = [
        (i, "http://hot.example/", f"<article><h1>T{i}</h1><p>Own text {i}</p><p>Share this</p></article>")
        for i in range(300)
    ]
    frame = pages.extract(made(spark, rows))
    assert texts(frame) == {i: f"T{i}\nOwn text {i}" for i in range(300)}
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "(host" in plan and "part" in plan


def test_alike_answers_in_unlike_places_are_no_template(spark):
    def page(i):
        answers = [f"Answer {k} of {i}" for k in range(3)]
        answers[i % 3] = "Yes"
        own = "".join(f"<section><h2>Question {k}</h2><p>{a}</p></section>" for k, a in enumerate(answers))
        return f"<article><h1>T{i}</h1>{own}</article>"

    found = texts(pages.extract(made(spark, [(i, f"http://y.example/{i}", page(i)) for i in range(6)])))
    for i, text in found.items():
        assert text.split("\n") == [f"T{i}", *("Yes" if k == i % 3 else f"Answer {k} of {i}" for k in range(3))]


def grown(rng, depth):
    tag, text = rng.choice("ab"), rng.choice(["", "x", "y"])
    inner = "".join(grown(rng, depth - 1) for _ in range(rng.randint(0, 3))) if depth else ""
    return f"<{tag}>{text}{inner}</{tag}>"


def brute(x, y):
    """The most weight of two trees, over all ways to pair their children in order."""
    if x.tag != y.tag:
        return 0

    def best(left, right):
        if not left or not right:
            return 0
        return max(
            best(left[1:], right), best(left, right[1:]), brute(left[0], right[0]) + best(left[1:], right[1:])
        )

    return 1 + (x.value is not None and x.value == y.value) + best(x.children(), y.children())


@pytest.mark.parametrize("cells", [0, 4, 1 << 20])
def test_tree_matching_finds_the_heaviest_pairs(cells):
    rng = random.Random(7)
    for _ in range(150):
        a, b = (pages.parse("".join(grown(rng, 2) for _ in range(rng.randint(1, 3)))) for _ in "ab")
        n, pairs = pages.matched(a, b, pages.Wrapper(cells=cells))
        weight = sum(1 + (x.value is not None and x.value == y.value) for x, y in pairs)
        assert n == len(pairs) == len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs})
        assert weight == brute(a, b)
        assert all(x.tag == y.tag for x, y in pairs)


def test_deep_and_wide_pages_are_matched_whole():
    a, b = (pages.parse("<div>" * 3000 + f"deep {k}<p>x</p>" + "</div>" * 3000) for k in "ab")
    assert pages.matched(a, b, pages.Wrapper())[0] == 3002
    a, b = (pages.parse("".join(f"<p>{(i * k) % 1009}</p>" for i in range(1500))) for k in (5, 7))
    one, halved = (pages.matched(a, b, pages.Wrapper(cells=c))[1] for c in (1 << 22, 1000))
    assert len({sum(1 + (x.value == y.value) for x, y in pairs if x.value) for pairs in (one, halved)}) == 1
