"""Hyperlinks of stored web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def page_links(pages: DataFrame, html: str = "html", out: str = "href") -> DataFrame:
    """One row per link target, in page order; duplicates are kept."""
    targets = F.regexp_extract_all(F.col(html), F.lit('href="([^"]*)"'), F.lit(1))
    return pages.withColumn(out, F.explode(targets))


def choose_links(
    links: DataFrame, has: list[str] | None = None, lacks: list[str] | None = None, href: str = "href"
) -> DataFrame:
    """Links that contain all of ``has`` and none of ``lacks``, as plain text."""
    test: Column = F.lit(True)
    for text in has or []:
        test = test & F.col(href).contains(text)
    for text in lacks or []:
        test = test & ~F.col(href).contains(text)
    return links.where(test)


def date_in_text(text: Column) -> Column:
    """The first ``yyyy.mm.dd`` in a text as a date; none or an impossible one is NULL."""
    found = F.regexp_extract(text, r"(\d{4}\.\d{2}\.\d{2})", 1)
    return F.try_to_timestamp(found, F.lit("yyyy.MM.dd")).cast("date")
