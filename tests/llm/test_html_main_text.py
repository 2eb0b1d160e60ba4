import html
import re

import pytest
from pyspark.sql import functions as F

from prosemill.llm.html_main_text import extract_main_text, main_text, op3_html_main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="<p>no</p>";</script></head><body>
<header><a href="/">Home</a> Site</header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site and want you to know</div>
{main}
<aside class="x">Read also this</aside><div id="comments"><p>First reader says something long enough to be dense text here</p></div>
<form><label>Mail</label><input name="q"></form><footer>&copy; all</footer></body></html>"""
BODY = "<h1>Title &amp; more</h1><p>First   paragraph with <b>bold</b> and <a href='/x'>a link</a> in it, long enough.</p><p>Second one<br>goes on &lt;here&gt;, also with words to count.</p>"
TEXT = "Title & more\nFirst paragraph with bold and a link in it, long enough.\nSecond one goes on <here>, also with words to count."


@pytest.mark.parametrize("main", [
    f"<article>{BODY}</article>", f"<div class='content'>{BODY}</div>", f"<main><div><section>{BODY}</section></div></main>",
    f"<article><div class='ad'>buy now</div>{BODY}<div class='share'>tweet</div></article>",
    f"<div><div>{BODY}</div></div>", f"<article>{BODY.replace('</p>', '')}</article>"])
def test_main_text(main):
    assert main_text(PAGE.format(main=main)) == TEXT


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("plain words only", "plain words only"), ("<p>a<p>b", "a\nb"),
    ("<p>one</b> two</p>", "one two"), ("<p>cut &am", "cut &am"), ("<p>a < b and c</p>", "a < b and c"),
    ("<p title='x > y'>q</p>", "q"), ("<p title=it's>q</p>", "q"), ("<script>never ends", ""), ("<!-- open <p>x</p>", "")])
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages_end():
    assert main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert len(main_text("<article>" + "<p>word word</p>" * 50_000 + "</article>")) == 50_000 * 10 - 1
    main_text("<" * 100_000)
    main_text("<a '" * 20_000)


def test_frame(spark):
    rows = [(1, "u", "<p>é x</p>"), (1, "u", "<p>é x</p>"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1)).withColumn("key", F.lit(2))
    out = extract_main_text(df)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, "u", "é x", 3)] * 2 + [(None, None, "", 0)], key=repr)
    assert extract_main_text(df.limit(0)).count() == 0


def test_query_equals_the_articles_of_the_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.page_id: r.text for r in op3_html_main_text(spark, sf).collect()}
    for page_id, page in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html").collect():
        inner = page[page.index("<article>") + 9:page.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[page_id] == "\n".join(b for b in blocks if b), page_id
