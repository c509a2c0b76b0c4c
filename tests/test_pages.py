"""Page layouts, links and the crawl."""

import time

import pandas as pd
from pyspark.sql import functions as F

from surveyloom import sources
from surveyloom.operators import webpages
from surveyloom.operators.markup import Reader

WJX = """<div class="field ui"><div class="field-label">1. How was your hotel room?</div>
<div class="ui-radio"> Good </div><div class="ui-checkbox x">Bad</div><select><option>请选择</option><option>Fine</option></select></div>
<div class="field"><div class="field-label">Unrelated words only</div></div><div class="field">no label</div>"""
WENJUAN = """<div class="question"><div class="question-title">2、您对我们的酒店满意吗</div><label>A. 满意</label><label>B. 不满意</label></div>
<div class="question"><div class="question-title">nothing here</div></div>"""
JOTFORM = """<ul><li class="form-line"><label class="form-label">Would you travel again?</label>
<label class="form-radio-item-label">Yes</label><label class="form-radio-item-label">No</label>
<select><option>Please Select</option><option>Maybe</option></select></li><li class="form-line"><label class="form-label">Name</label></li></ul>"""
GENERIC = """<html><head><style>p{}</style></head><body><nav><p>How was the hotel in the menu?</p></nav>
<p>What did you like about the trip?</p><ul><li>Food</li><li>Sea<br></li></ul>
<section><h3>Which transport for the tour (bus/train/plane ride)?</h3></section><p>Too short</p><script>var a = "<p>how hotel</p>";</script></body></html>"""
LINKS = """<div><a href="/r/one?a=1&amp;b=2">x</a> <a class="k" href='https://www.surveymonkey.com/r/two'>y</a> <a href="/other">z</a></div>"""
PAGES = "page_id bigint, url string, html string, source_name string"


def blocks(table, *pages):
    return webpages.text_blocks(table(PAGES, *pages))


def test_layouts(table, rows):
    found = webpages.page_questions(blocks(
        table, (1, "http://www.wjx.cn/vm/1", WJX, "s1"), (2, "http://wenjuan.com/s/2", WENJUAN, "s2"),
        (3, "http://form.jotform.com/3", JOTFORM, "s3")))
    assert rows(found, "page_id", "question_text", "options_text", "question_type", "category", "language", "source_name") == [
        (1, "How was your hotel room?", "Good / Bad / Fine", "single_choice", "room", "en", "问卷星"),
        (2, "您对我们的酒店满意吗", "满意 / 不满意", "single_choice", "satisfaction", "zh", "问卷网"),
        (3, "Would you travel again?", "Yes / No / Maybe", "yes_no", "general", "en", "Jotform")]


def test_generic(table, rows):
    found = webpages.page_questions(blocks(table, (1, "http://x.org", GENERIC, "site"), (2, "http://y.org", LINKS, "s"), (3, "http://z.org", None, "s")))
    assert rows(found, "page_id", "question_text", "options_text", "source_name") == [
        (1, "What did you like about the trip?", "Food / Sea", "site"),
        (1, "Which transport for the tour ?", "bus / train / plane ride", "site")]


def test_broken_html(table, rows):
    odd = "<div><p>How is the hotel<b> room?</div></p></i><p>Which trip or tour would you take"
    found = webpages.page_questions(blocks(table, (1, "http://x.org", odd, "s")))
    assert ("How is the hotelroom?",) in rows(found, "question_text")


def test_links(table, rows):
    page = table(PAGES, (5, "https://www.surveymonkey.com/list", LINKS, "s"))
    assert rows(webpages.page_links(page), "page_seq", "link_pos", "url") == [
        (5, 0, "https://www.surveymonkey.com/r/one?a=1&b=2"), (5, 1, "https://www.surveymonkey.com/r/two")]


def test_crawl(table, rows):
    question = "<p>How was the hotel room {}?</p>"
    hub = '<a href="https://www.surveymonkey.com/r/a">a</a><a href="https://www.surveymonkey.com/r/b">b</a>'
    pages = table("page_id bigint, url string, html string",
                  (1, "http://one.org", question.format(1)), (2, "http://hub.org", hub), (3, "http://gone.org", None),
                  (4, "https://www.surveymonkey.com/r/a", question.format(2) + question.format(1)),
                  (5, "https://www.surveymonkey.com/r/b", "<p>nothing</p>"), (6, "http://never.org", question.format(9)),
                  (7, "http://empty.org", "<p>none</p>"))
    seeds = table("url string, source_name string", ("http://one.org", "one"), ("http://hub.org", "hub"), ("http://gone.org", "gone"), ("http://empty.org", "empty"))
    out = webpages.crawl(pages, seeds)
    assert rows(out["questions"], "question_text", "source_name") == [("How was the hotel room 1?", "http://one.org"), ("How was the hotel room 2?", "hub")]
    assert rows(out["outcomes"], "page_id", "outcome", "links_used", "questions") == [
        (1, "direct", 0, 1), (2, "sublinks", 1, 2), (3, "failed", 0, 0), (7, "empty", 0, 0)]
    assert rows(out["counters"], "*") == [(1, 2, 1, 1, 3)]


def test_first_seed_in_the_lists_counts(table, rows):
    pages = table("page_id bigint, url string, html string", (1, "http://hub.org", '<a href="https://www.surveymonkey.com/r/a">a</a>'),
                  (2, "https://www.surveymonkey.com/r/a", "<p>How was the hotel room?</p>"))
    lists = [table("seq bigint, url string, source_name string", *given) for given in ([(5, "http://hub.org", "zebra"), (7, "http://hub.org", "bear")], [(1, "http://hub.org", "ant")])]
    seeds = sources.seed_pages(*lists)
    assert rows(seeds, "list", "seq", "source_name") == [(0, 5, "zebra"), (0, 7, "bear"), (1, 1, "ant")]
    assert rows(webpages.crawl(pages, seeds)["questions"], "question_text", "source_name") == [("How was the hotel room?", "zebra")]


def _texts(page, skipped=frozenset()):
    outline = webpages.Outline(page, skipped)
    return [(tag, outline.text(n)) for n, tag in enumerate(outline.tags)]


def test_reader_forgives():
    page = """a &lt b<!-- <p>no --><p class='x y' id=z title="1 > 0">c &amp; d<br/>e</P ><!DOCTYPE x><![foo[x]]>f<?php g?>h</ i>j < k<script>"</p>"</script><textarea><b>l</textarea>"""
    events = list(Reader(page))
    assert "".join(v for kind, v, _ in events if kind == "text") == 'a < bc & defhj < k"</p>"<b>l'
    assert [(kind, v, more) for kind, v, more in events if kind in ("start", "empty")] == [
        ("start", "p", {"class": "x y", "id": "z", "title": "1 > 0"}), ("empty", "br", {}), ("start", "script", {}), ("start", "textarea", {})]
    assert list(Reader("")) == [] and [v for _, v, _ in Reader("x<")] == ["x<"]
    assert [v for kind, v, _ in Reader('<a href="never closed>b<i>c') if kind == "text"] == ["b", "c"]
    assert [(kind, more) for kind, _, more in Reader("<a href=/><b/ ><i / x>")] == [("start", {"href": "/"}), ("start", {}), ("start", {"x": ""})]
    assert [v for kind, v, _ in Reader("a<!-- never closed>b") if kind == "text"] == ["a", "b"]


def test_text_after_refused_markup_stays(table, rows):
    page = "<p>How was the hotel?</p><![foo[x]]><p>How was the room here?</p><!ELEMENT x><p>How was the bus trip?</p>"
    found = webpages.page_questions(blocks(table, (1, "http://x.org", page, "s")))
    assert rows(found, "question_text") == [("How was the bus trip?",), ("How was the hotel?",), ("How was the room here?",)]


def test_elements_and_hidden_text():
    assert _texts("<div>a<p>b<b> c </b></div>d</p><template>e<p>f</p></template>g") == [
        ("div", "abc"), ("p", "bc"), ("b", "c"), ("template", "e" + "f"), ("p", "f")]
    assert _texts("<div>a<template>b</template><script>c</script>d</div>")[0] == ("div", "ad")
    # A skipped element that stays open ends with the element around it.
    assert _texts("<div><nav><p>menu</div><p>after</p>", {"nav"}) == [("div", ""), ("p", "after")]
    assert _texts("<nav><div></div>menu</nav><p>after</p><nav/>", {"nav"}) == [("p", "after")]


def test_deep_and_broken_pages_take_linear_time():
    for page in (
        "<div>" * 4_000 + "How was the hotel?" + "</div>" * 4_000, "<p>" * 60_000 + "x", "<b>" * 60_000 + "</i>" * 60_000,
        '<a href="' * 110_000, "<a href='x" + " y=" * 330_000, "<a " + " " * 1_000_000, "<!--" * 250_000, "</" * 500_000, "<script>" * 125_000, "&" * 1_000_000, "<p><ul><li>" * 30_000 + "<label>"):
        started = time.time()
        list(webpages._generic_blocks(page, 8, 500))
        list(webpages._layout_blocks(page, webpages.LAYOUTS["jotform"]))
        assert time.time() - started < 5, page[:20]
    started = time.time()
    assert len(list(webpages._generic_blocks("<div>" * 4_000 + "How was the hotel?" + "</div>" * 4_000, 8, 500))) == 4_000
    assert time.time() - started < 1


def test_unreadable_page_is_reported(table, rows, monkeypatch):
    """A page whose reading fails gives an error and the outcome ``failed``; the others are read."""
    pages = table("page_id bigint, url string, html string", (1, "http://one.org", "<p>How was the hotel room?</p>"), (2, "http://bad.org", "<p>How was the hotel bus?</p>"))
    seeds = table("url string, source_name string", ("http://one.org", "one"), ("http://bad.org", "bad"))
    plain = webpages.parsed_pages

    def parsed(some, *bounds):
        bad = F.col("page_id") == 2
        read = plain(some, *bounds)
        first = read.where(bad).limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in ("pos", "raw_text", "raw_options") else F.lit("ValueError: x").alias("error") if f.name == "error" else f.name for f in read.schema.fields])
        return read.where(~bad).unionByName(first)

    monkeypatch.setattr(webpages, "parsed_pages", parsed)
    out = webpages.crawl(pages, seeds)
    assert rows(out["errors"], "*") == [(2, "ValueError: x")] and rows(out["questions"], "page_id") == [(1,)]
    assert rows(out["outcomes"], "page_id", "outcome") == [(1, "direct"), (2, "failed")]


def test_error_rows_come_from_the_task():
    class Bad(str):
        def find(self, *_):
            raise ValueError("unreadable")

    batch = pd.DataFrame({"page_id": [1, 2], "url": ["u", "v"], "source_name": ["u", "v"], "site": ["generic", "generic"], "html": [Bad("<p>How was the hotel?</p>"), "<p>How was the hotel?</p>"]})
    got = next(webpages._cut_blocks(8, 500)(iter([batch])))
    assert got["error"].tolist() == ["ValueError: unreadable", None] and got["raw_text"].tolist() == [None, "How was the hotel?"]


def test_only_seeds_and_their_links_are_parsed(table, monkeypatch):
    hub = '<a href="https://www.surveymonkey.com/r/a">a</a>'
    own = '<p>How was the hotel room?</p><a href="https://www.surveymonkey.com/r/b">b</a>'
    pages = table("page_id bigint, url string, html string", (1, "http://own.org", own), (2, "http://hub.org", hub), (3, "https://www.surveymonkey.com/r/a", own),
                  (4, "https://www.surveymonkey.com/r/b", own), *[(10 + i, f"http://other{i}.org", own) for i in range(50)])
    parsed, plain = [], webpages.parsed_pages
    monkeypatch.setattr(webpages, "parsed_pages", lambda some, *bounds: parsed.extend(r.page_id for r in some.collect()) or plain(some, *bounds))
    webpages.crawl(pages, table("url string, source_name string", ("http://own.org", "own"), ("http://hub.org", "hub")))
    assert sorted(parsed) == [1, 2, 3]
