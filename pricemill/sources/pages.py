"""Stored web pages: fields, notices, links, select boxes and the work list they give."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemill.functions.text import strip

# An anchor with its target and text, and an option of a select box.
ANCHOR = r'(?is)<a\b[^>]*?\bhref="([^"]*)"[^>]*>(.*?)</a>'
OPTION = r"(?is)<option\b[^>]*>(.*?)</option>"


def page_fields(
    pages: DataFrame, fields: Mapping[str, Column], keep: Sequence[str] = ("page_id",)
) -> DataFrame:
    """Fields read from the markup, one row per page (see ``functions.text.table_cell``)."""
    return pages.select(*keep, *[value.alias(name) for name, value in fields.items()])


def without_notice(pages: DataFrame, notice: str, html: str = "html") -> DataFrame:
    """Drop pages that carry a notice such as 'no prices'."""
    return pages.filter(~F.contains(F.col(html), F.lit(notice)))


def page_links(
    pages: DataFrame,
    text: str | None = None,
    first: int | None = None,
    keep: Sequence[str] = ("page_id",),
    html: str = "html",
) -> DataFrame:
    """Links of each page in page order: ``pos``, ``href`` and ``link_text``.

    ``text`` keeps the links with that text, ``first`` the first n of what is left on a page.
    """
    # The page is searched once; the parts are then read from each short anchor.
    anchors = F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(0))
    found = F.transform(
        anchors,
        lambda a: F.struct(
            F.regexp_extract(a, ANCHOR, 1).alias("href"),
            F.regexp_extract(a, ANCHOR, 2).alias("link_text"),
        ),
    )
    if text is not None:
        found = F.filter(found, lambda a: strip(a["link_text"]) == text)
    if first is not None:
        found = F.slice(found, 1, first)
    # The outer form: for the plain one Spark adds a not-empty filter that searches again.
    return (
        pages.select(*keep, F.posexplode_outer(found).alias("pos", "_link"))
        .filter(F.col("pos").isNotNull())
        .select(*keep, "pos", "_link.href", "_link.link_text")
    )


def select_options(
    pages: DataFrame,
    keep: Sequence[str] = ("page_id",),
    skip: int = 1,
    html: str = "html",
) -> DataFrame:
    """Options of the select box of a page, from the one after the ``skip`` leading ones on."""
    options = F.transform(F.regexp_extract_all(F.col(html), F.lit(OPTION), F.lit(1)), strip)
    return pages.select(*keep, F.posexplode_outer(options).alias("pos", "option")).filter(
        F.col("pos") >= skip
    )


def work_list(offered: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is offered and not loaded yet, for example (market, product).

    Each market's page lists its own products, so the pairs are read and not multiplied out.
    """
    return offered.select(*keys).distinct().join(
        loaded.select(*keys).distinct(), on=list(keys), how="left_anti"
    )
