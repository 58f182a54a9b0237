"""Choosing data files among the links of a page."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from spoorlens.functions.text import (
    file_name, page_address, resolve_link, strip, unescape_attribute, unquote,
)
from spoorlens.functions.values import to_int
from spoorlens.session import spread_if_small

# --- fixed values: file names ---------------------------------------------------
SERVICES_YEARLY = r"^services-(\d{4})\.csv\.gz$"
SERVICES_MONTHLY = r"^services-(\d{4})-(\d{2})\.csv\.gz$"
DISRUPTIONS_YEARLY = r"^disruptions-(\d{4})\.csv$"
FIRST_YEAR = 2019
STATIONS_FILE = "stations-2023-09.csv"
DISTANCES_FILE = "tariff-distances-2022-01.csv"

# Markup whose content is not read as tags.
_OPAQUE = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
# An anchor tag; its quoted values may hold ">". Then one attribute of it.
_ANCHOR = r"""(?is)<a[\s/](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_ATTRIBUTE = r"""(?s)[^\s"'>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?"""


def _href(tag):
    """Value of the last href of a tag, null without one and empty for a bare href."""
    attributes = F.regexp_extract_all(F.substr(tag, F.lit(3)), F.lit(_ATTRIBUTE), F.lit(0))
    named = F.filter(attributes, lambda a: a.rlike(r"(?i)^href\s*(=|$)"))
    return F.regexp_extract(F.try_element_at(named, F.lit(-1)), r"(?s)^[^=]*=\s*(.*)$", 1)


# What the link to a known file holds as it stands, before it is resolved.
STEMS = ("services-", "disruptions-", STATIONS_FILE, DISTANCES_FILE)


def page_links(pages: DataFrame, url: str = "url", html: str = "html", holding: Sequence[str] = ()) -> DataFrame:
    """One row per anchor link of each page: other columns, ``pos``, ``link``, ``file_name``.

    Links are resolved inside the array, before it is exploded: filters on the link then
    apply to finished columns, where they would otherwise repeat the whole extraction.
    With ``holding``, only links that hold one of the texts are resolved and returned; a
    file name of plain characters stands in a link as it is.
    """
    keep = [c for c in pages.columns if c != html]
    visible = F.regexp_replace(F.col(html), _OPAQUE, "")
    tags = F.regexp_extract_all(visible, F.lit(_ANCHOR), F.lit(0))
    parts = page_address(F.col(url))
    # A step of its own: these are worked out once per page, not once per link.
    per_page = spread_if_small(pages).select(*keep, tags.alias("_tags"), *[c.alias(f"_{n}") for n, c in parts.items()])
    address = {n: F.col(f"_{n}") for n in parts}
    hrefs = F.filter(F.transform("_tags", _href), lambda h: h.isNotNull())
    placed = F.transform(hrefs, lambda h, n: F.struct(n.alias("pos"), h.alias("href")))
    if holding:
        placed = F.filter(placed, lambda x: reduce(lambda a, b: a | b, [x["href"].contains(t) for t in holding]))

    def resolved(x):
        return x["pos"], resolve_link(F.col(url), address, strip(unescape_attribute(unquote(x["href"]))))

    links = F.transform(placed, lambda x: F.struct(*[c.alias(n) for n, c in zip(("pos", "link"), resolved(x))]))
    named = F.transform(links, lambda a: F.struct(a["pos"].alias("pos"), a["link"].alias("link"), file_name(a["link"]).alias("file_name")))
    return per_page.select(*keep, F.inline(named))


def service_files(files: DataFrame, first_year: int = FIRST_YEAR) -> DataFrame:
    """Stop-event files from ``first_year`` on, in order of year and name.

    A year that has a yearly file uses it and not its monthly ones. The years with a
    yearly file are found by an aggregate of at most 10,000 rows (four digits), so that
    join can always be broadcast and no year has to sit in one task.
    """
    name = F.col("file_name")
    yearly = to_int(F.regexp_extract(name, SERVICES_YEARLY, 1))
    monthly = to_int(F.regexp_extract(name, SERVICES_MONTHLY, 1))
    matched = files.withColumns({
        "year": F.coalesce(yearly, monthly), "is_yearly": yearly.isNotNull(),
    }).filter(F.col("year") >= first_year)
    whole_years = matched.filter("is_yearly").select(F.col("year").alias("_whole")).distinct()
    chosen = matched.join(F.broadcast(whole_years), F.col("year") == F.col("_whole"), "left").filter(
        F.col("is_yearly") | F.col("_whole").isNull()
    )
    return chosen.drop("_whole", "is_yearly").orderBy("year", "file_name", *[c for c in ("url", "pos") if c in files.columns])


def disruption_files(files: DataFrame, first_year: int = FIRST_YEAR) -> DataFrame:
    year = to_int(F.regexp_extract("file_name", DISRUPTIONS_YEARLY, 1))
    return files.withColumn("year", year).filter(F.col("year") >= first_year).orderBy(
        "file_name", *[c for c in ("url", "pos") if c in files.columns]
    )


def known_files(files: DataFrame) -> DataFrame:
    """Only files of a known kind, with ``dataset``."""
    name = F.col("file_name")
    dataset = (
        F.when(name.rlike(SERVICES_YEARLY) | name.rlike(SERVICES_MONTHLY), "services")
        .when(name.rlike(DISRUPTIONS_YEARLY), "disruptions")
        .when(name == STATIONS_FILE, "stations")
        .when(name == DISTANCES_FILE, "tariff_distances")
    )
    return files.withColumn("dataset", dataset).filter(F.col("dataset").isNotNull())


def exact_file(files: DataFrame, wanted: str, order: list[str]) -> DataFrame:
    """The first link to the named file."""
    return files.filter(F.col("file_name") == wanted).orderBy(*order).limit(1)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """``df`` itself; raises where it has no row. Runs a job that stops at the first row."""
    if df.isEmpty():
        raise LookupError(message)
    return df
