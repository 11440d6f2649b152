"""Listing pages: anchors and text blocks with inner markup."""

from recspark.sources.pages import first_tag_text, listing_links


def test_links_and_text(spark):
    html = ("<PRE class='x'>2008-11-03 &lt;b&gt; <i>note</i>\n&amp;lt;</PRE>"
            "<A HREF='1'><b>FR_216</b></A><a>plain</a><abbr>no_link</abbr><a\nid='2'>FR_\n253</a >")
    pages = spark.createDataFrame([(1, html), (2, ""), (3, None)], "page_id long, html string")
    got = [(r.page_id, r.link_pos, r.anchor) for r in listing_links(pages).collect()]
    assert sorted(got) == [(1, 0, "FR_216"), (1, 2, "FR_\n253")]
    left = listing_links(pages, exclude=["FR_216"]).collect()
    assert [r.anchor for r in left] == ["FR_\n253"]
    text = {r.page_id: r.text for r in first_tag_text(pages).collect()}
    assert text == {1: "2008-11-03 <b> note\n&lt;", 2: "", 3: None}
