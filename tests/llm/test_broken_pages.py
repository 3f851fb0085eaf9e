"""Pages that are broken, deep or very long, and text that repeats on every page of a host."""

import time
import tracemalloc

import pytest

from salesnet.llm import template

BROKEN = {
    "unclosed tags": ("<a " * 300_000, "<a <a"),
    "unclosed tags, one end": ("<p>one</p>" + "<b " * 300_000 + ">two", "one\n\ntwo"),
    "quotes without end": ("<p>one</p>" + '<a "' * 250_000 + "\" ' >two", "one"),
    "quote without end": ("<p>one</p><i class=\"x>two</i><p>three</p>", "one\n\ntwo\n\nthree"),
    "declarations": ("<p>one</p>" + "<!" * 500_000, "one\n\n<!<!"),
    "comment without end": ("<p>one</p>" + "<!-- " * 200_000, "one"),
    "script without end": ("<p>one</p><script>" + "</script " * 100_000, "one"),
    "signs": ("<" * 1_000_000, "<<<"),
    "nested": ("<div>" * 100_000 + "deep", "deep"),
    "nested with ids": ("".join(f"<div id=i{i}>" for i in range(100_000)) + "deep", "deep"),
    "end tags of nothing": ("<div>" * 50_000 + "</p>" * 100_000 + "deep", "deep"),
    "list in a deep list": ("<li><ul>" + "<div>" * 20_000 + "<li></li>" * 40_000 + "<li>deep", "deep"),
    "side by side": ("".join(f"<div id=i{i}>t{i}</div>" for i in range(40_000)), "t0\n\nt1\n\nt2"),
    "long class": ("<div class='" + "a-" * 300_000 + "'><div>one<div>two", "one\n\ntwo"),
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_and_deep_pages_take_linear_time_and_memory(name):
    page, text = BROKEN[name]
    started = time.process_time()
    assert template.main_text(page, None).startswith(text)
    assert time.process_time() - started < 20
    tracemalloc.start()
    template.parse(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


def test_deep_pages_through_the_operator(spark):
    deep = "<body>" + "<div class='layer'>" * 20_000
    rows = [(i, "http://deep.org/", f"{deep}<p>{'text of the page ' * 5}{i}</p>") for i in range(3)]
    got = template.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"], r["text"]) for r in got) == [(i, "text of the page " * 5 + str(i)) for i in range(3)]


def pages_of(spark, bodies):
    rows = [(i, "http://a.org/x", f"<html><body><article>{b}</article></body></html>") for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def texts(pages):
    return [r["text"].split("\n\n") for r in sorted(template.extract_main_text(pages).collect())]


def own(i):
    return f"<h1>Title {i}</h1><p>{'words of the page ' * 6}{i}</p><div class=c7><p>Our shop &amp; more</p><b>now</b></div><p>again</p><p>end {i}"


def test_text_on_every_page_of_a_host_is_template(spark):
    wanted = [[f"Title {i}", "words of the page " * 6 + str(i), "again", f"end {i}"] for i in range(6)]
    assert texts(pages_of(spark, [own(i) for i in range(6)])) == wanted


def test_text_on_most_pages_or_few_pages_stays(spark):
    most = texts(pages_of(spark, [own(i) for i in range(5)] + [own(5).replace("shop", "shed")]))
    assert all(len(t) == 6 and t[2].startswith("Our sh") for t in most)
    assert all(len(t) == 6 for t in texts(pages_of(spark, [own(i) for i in range(template.MIN_PAGES - 1)])))
    twice = own(2) + "<div class=c7>Our shop &amp; more</div>"  # another occurrence vector
    assert all("Our shop & more" in t for t in texts(pages_of(spark, [own(0), own(1), twice, own(3), own(4)])))


def test_copies_of_one_page_keep_their_text(spark):
    assert all(len(t) == 6 for t in texts(pages_of(spark, [own(1)] * 8)))


def test_pages_without_one_element_around_them(spark):
    rows = [(i, "http://f.org/", f"<p>first {i}</p><p>second {i}</p>") for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert texts(pages) == [[f"first {i}", f"second {i}"] for i in range(3)]
