"""Fetched listing pages (S10) and listing -> patient directory names.

The reference logged into a web site and copied files; here the pages are a
DataFrame already fetched (``page_id, url, html``) and the work is the
extraction and the naming rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANCHOR_PATTERN = r"(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>"
# named entities of plain text (fixed values); the ampersand comes last
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", " "), ("&amp;", "&"))


def element_text(inner: Column) -> Column:
    """Text of an element's content: inner tags removed, entities decoded."""
    out = F.regexp_replace(inner, "<[^>]*>", "")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def listing_links(pages: DataFrame, must_contain: str | None = "_",
                  exclude: DataFrame | Sequence[str] | None = None,
                  html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """Anchor texts of each page (``page_id, link_pos, anchor``), kept when they
    contain ``must_contain`` and are not in ``exclude`` (a list of names or a
    one-column frame ``anchor``, applied as an anti-join)."""
    anchors = F.transform(F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR_PATTERN), 1),
                          element_text)
    out = pages.select(id_col, F.posexplode(anchors).alias("link_pos", "anchor"))
    if must_contain:
        out = out.where(F.col("anchor").contains(must_contain))
    if exclude is not None:
        if isinstance(exclude, DataFrame):
            out = out.join(exclude.select("anchor").distinct(), "anchor", "left_anti")
        else:
            out = out.where(~F.col("anchor").isin(list(exclude)))
    return out.select(id_col, F.col("link_pos").cast("int").alias("link_pos"), "anchor")


def first_tag_text(pages: DataFrame, tag: str = "pre", html_col: str = "html",
                   id_col: str = "page_id") -> DataFrame:
    """Text of the first ``<tag>`` element of each page ('' when absent).
    With ``tag='pre'`` this is the annotation list of a patient page."""
    pattern = rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"
    text = element_text(F.regexp_extract(F.col(html_col), pattern, 1))
    return pages.select(id_col, text.alias("text"))


def resolve_listing_dirs(listings: DataFrame, existing_dirs: DataFrame,
                         listing_col: str = "listing", suffixes: Sequence[str] = ("02", "03"),
                         dir_col: str = "dir_name") -> DataFrame:
    """``FR_<n>`` -> the first of ``pat_<n>02``, ``pat_<n>03`` that exists.

    Candidates are exploded with their priority, equi-joined to the existing
    directory names and reduced with ``min_by`` per listing; listings with no
    existing candidate keep a NULL directory.
    """
    n = F.regexp_extract(F.col(listing_col), r"(\d+)$", 1)
    cands = F.array(*[F.struct(F.lit(i + 1).alias("priority"),
                               F.concat(F.lit("pat_"), n, F.lit(sfx)).alias(dir_col))
                      for i, sfx in enumerate(suffixes)])
    exploded = listings.select(listing_col, F.explode(cands).alias("_c")).select(
        listing_col, "_c.priority", f"_c.{dir_col}")
    hits = exploded.join(existing_dirs.select(dir_col).distinct(), dir_col, "left_semi")
    best = hits.groupBy(listing_col).agg(
        F.min_by(dir_col, "priority").alias(dir_col), F.min("priority").alias("priority"))
    return listings.select(listing_col).join(best, listing_col, "left")


def dataset_of_package(package) -> "F.Column":
    """``inv_30`` -> ``inv``: the package name up to the first underscore."""
    return F.regexp_extract(package if not isinstance(package, str) else F.col(package),
                            r"^([^_]+)", 1)
