"""Archive link discovery and download work list."""

from shelfline.sources import links as L

BASE = "https://example.org/opendata"


def links(spark, html, base=BASE, suffix=".zip"):
    pages = spark.createDataFrame([(base, html)], "url string, html string")
    return [r.link for r in L.discover_links(pages, suffix).collect()]


def test_every_anchor_form(spark):
    """Quoted either way, bare, upper case, behind other attributes, escaped."""
    html = ("<p>daily files</p><A HREF='a/q1.zip'>one</A> <a class=x href=q2.zip>two</a>"
            '<a title="see href=no.zip" data-href="no2.zip" href="/top/q3.Zip" rel>three</a>'
            '<a href="q4.zip?x=1&amp;y=.zip">four</a><a\nhref="&#113;5&#x2e;zip">five</a>')
    assert links(spark, html) == ["https://example.org/top/q3.Zip", "https://example.org/q5.zip",
                                  "https://example.org/q4.zip?x=1&y=.zip", "https://example.org/q2.zip",
                                  "https://example.org/a/q1.zip"]


def test_what_is_not_a_link(spark):
    html = ('<!-- <a href="old.zip">gone</a> --><a data-href="d.zip">x</a><abbr href="b.zip">y</abbr>'
            '<a name="z.zip">z</a><a href="page.htm">p</a><!-- open <a href="never.zip">')
    assert links(spark, html) == []


def test_same_target_once_in_falling_order(spark):
    html = "".join(f'<a href="{x}">.</a>' for x in ("b.zip", "./b.zip", "x/../b.zip", "c.zip", "/a.zip", "a.zip"))
    assert links(spark, html) == [f"https://example.org/{x}.zip" for x in "cba"]


def test_dot_segments_of_any_depth(spark):
    base = "https://e.org/1/2/3/4/5/6/list.html"
    cases = {"../../../../../x.zip": "https://e.org/1/x.zip", "../" * 9 + "x.zip": "https://e.org/x.zip",
             "a/./b/../c/../../x.zip": "https://e.org/1/2/3/4/5/6/x.zip", "/../../x.zip": "https://e.org/x.zip",
             "https://h.net/a/../b.zip": "https://h.net/b.zip"}
    for href, want in cases.items():
        assert links(spark, f'<a href="{href}">x</a>', base=base) == [want]


def test_relative_forms(spark):
    html = ('<a href="x/2026-01-01.ZIP">a</a><a href="https://cdn.example.net/d.zip">b</a>'
            "<a href='//mirror.example.com/m.zip'>c</a><a href=\"../up/u.zip\">d</a>")
    got = set(links(spark, html, base="https://example.org/data/list.html?p=1"))
    assert got == {"https://example.org/data/x/2026-01-01.ZIP", "https://cdn.example.net/d.zip",
                   "https://mirror.example.com/m.zip", "https://example.org/up/u.zip"}


def test_incremental_worklist(spark):
    ls = spark.createDataFrame([("https://e.org/f/2026-04-01.zip",), ("https://e.org/f/2026-04-02.zip",),
                                ("https://e.org/f/2026-04-03.zip",)], "link string")
    have = spark.createDataFrame([("2026-04-01.zip",), ("2026-04-02.zip",)], "file_name string")
    got = [r.file_name for r in L.incremental_worklist(ls, have).collect()]
    assert got == ["2026-04-03.zip"]
    got = [r.file_name for r in L.incremental_worklist(ls, have, force_from="2026-04-02").collect()]
    assert got == ["2026-04-03.zip", "2026-04-02.zip"]


def test_references_never_raise(spark):
    """Numbers of any size, surrogates, control codes, names with and without semicolon: as the standard library reads them."""
    import html

    from pyspark.sql import functions as F

    refs = [f"&#{n};" for n in (0, 1, 9, 11, 13, 31, 65, 127, 128, 129, 150, 159, 160, 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFFFD, 0xFFFE,
                                0x1F600, 0x1FFFF, 0x10FFFD, 0x10FFFF, 1114112, 9999999, 10**30)]
    refs += ["&#xD800;", "&#X41;", "&#x0000041", "&#65", "&#00065;", "&#xFFFFFFFFFFFFFFFFFFFF;", "&amp;", "&AMP;", "&amp", "&eacute;",
             "&NotEqualTilde;", "&CounterClockwiseContourIntegral;", "&copy", "&nosuch;", "&;", "&", "&&#65;&", "&#;", "&#x;", "&lt;&gt;&quot;&apos;"]
    cases = [(r, f"{r}{a}x.zip") for r in refs for a in ("", "&", ";")]
    df = spark.createDataFrame(cases, "ref string, text string").repartition(3)
    got = {r.text: r.out for r in df.select("text", L.unescape_html(F.col("text")).alias("out")).collect()}
    for ref, text in cases:
        want = html.unescape(text)
        if text.startswith(("&copyx", "&ampx")):
            want = text
        assert got[text] == want, text


def test_a_name_before_an_equals_sign_is_a_parameter(spark):
    assert links(spark, '<a href="d.zip?a=1&copy=2&lt;=.zip">x</a>') == ["https://example.org/d.zip?a=1&copy=2<=.zip"]


def test_bad_references_do_not_hide_other_links(spark):
    html = ('<a href="a&#1114112;.zip">1</a><a href="b&#xD800;.zip">2</a><a href="c&#9999999;.zip">3</a><a href="d&eacute;.zip">4</a>'
            '<a href="e&#99999999999999999999;.zip">5</a><a href="f.zip">6</a>')
    assert links(spark, html) == [
        f"https://example.org/{x}.zip" for x in ("f", "e\ufffd", "dé", "c\ufffd", "b\ufffd", "a\ufffd")]


def test_blanks_around_a_link(spark):
    html = '<a href="  x.zip">1</a><a href="y.zip ">2</a><a href="z\n\t.zip">3</a>'
    assert links(spark, html) == ["https://example.org/z.zip", "https://example.org/x.zip"]  # "y.zip " has another ending


def test_worklist_takes_the_ending_only(spark):
    ls = spark.createDataFrame([("https://e.org/a.zip.zip",), ("https://e.org/2026-04-09.ZIP",)], "link string")
    have = spark.createDataFrame([], "file_name string")
    assert [r.file_date for r in L.incremental_worklist(ls, have).collect()] == ["a.zip", "2026-04-09"]
