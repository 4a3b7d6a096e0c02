"""Pages as they are found: attributes, case, quotes, white space, entities."""

import html as stdlib_html

import pytest
from pyspark.sql import functions as F

from laborlens.operators import html as H


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "h string").select(column(F.col("h")).alias("x")).first().x


@pytest.mark.parametrize("cell", ["AT&amp;T &nbsp;Ltd", "a &lt;b&gt; c", "&amp;lt;", "&#8377;5 &#x20B9;6 &#X26;amp;", "&eacute;t&eacute; &",
                                  "plain", "", "&quot;x&quot;", "日本 &copy; 😀"])
def test_entities_as_the_standard_library(spark, cell):
    assert one(spark, H.unescape, cell) == stdlib_html.unescape(cell)


def test_what_is_no_character_stays(spark):
    cell = "&nosuch; &#55296; &#99999999; &#0; &"
    assert one(spark, H.unescape, cell) == cell


def test_cells_of_tolerant_tables(spark):
    page = ("<TABLE class='x'><THEAD><TR ><TH scope=col> State <br>Name </TH><th>N&nbsp;</th></TR></THEAD><tbody>"
            "<tr id=1><td> <b>AT&amp;T</b> <i>&nbsp;Ltd</i></td><TD align='right'>\n 1,200 </TD ></tr></tbody></TABLE>")
    assert one(spark, H.row_cells, page) == [["StateName", "N"], ["AT&TLtd", "1,200"]]
    df = spark.createDataFrame([(1, page)], "id int, h string")
    assert [r.rec for r in H.header_records(df, "h", ["id"]).collect()] == [{"statename": "AT&TLtd", "n": "1,200"}]


@pytest.mark.parametrize("open_tag", ['<script data-rh="true" type="application/ld+json">', "<SCRIPT type='application/ld+json' async>",
                                      "<script\n type = application/ld+json >"])
@pytest.mark.parametrize("body,n", [('\n [{"@type":"JobPosting","title":"a"},{"@type":"X"},{"@type":"JobPosting","title":"b"}] ', 2),
                                    ('\n{"@type":"JobPosting","title":"a"}', 1), ("not json", 0), ("[]", 0)])
def test_json_ld_blocks(spark, open_tag, body, n):
    page = f"<p>{open_tag}{body}</script >" + '<script type="text/javascript">{"@type":"JobPosting"}</script>'
    got = one(spark, lambda h: H.ld_postings(h, F.lit("pune")), page)
    assert [(p.title, p.location) for p in got] == [("a", "Pune"), ("b", "Pune")][:n]


@pytest.mark.parametrize("page", ['<div class="base-card"><a class="base-card__full-link" href=\'u\'></a><H3 class=base-search-card__title>a &amp; b</H3></div>',
                                  '<article class="jobTuple"><a class="title" href="v"> x &lt; y</a><ul><li class="location"><span>P</span><li>z</ul></article>',
                                  '<!-- c --><li class="result-card"><time datetime="2024-01-01">n</time></li>', '<div class="base-card"><br/>a<b'])
def test_plain_pages_take_the_short_way_to_the_same_cards(page, monkeypatch):
    """plain markup is cut by one pattern; every page gives what the standard library's parser gives."""
    from laborlens.operators import cards as C
    quick = C.parse_cards(page)
    assert (C.plain_tree(page) is not None) == page.startswith("<article")
    monkeypatch.setattr(C, "plain_tree", lambda html: None)
    assert C.parse_cards(page) == quick and len(quick) == 1
