"""Text expressions for calendar feeds, links and file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values: names that mark a clock change, lower case -------------------
CLOCK_CHANGES = ["summer time", "winter time"]


def strip(c: Column) -> Column:
    """Trim every kind of white space, where ``trim`` removes spaces only."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def english_name(title: Column) -> Column:
    """Text of a closing parenthesis, ``Kerst (Christmas)``, else the whole title."""
    title = F.coalesce(title, F.lit(""))
    inner = F.regexp_extract(title, r"\(([^)]+)\)\s*$", 1)
    return strip(F.when(inner != "", inner).otherwise(title))


def first_date(c: Column) -> Column:
    """The first run of eight digits as a date; null where it is not one."""
    digits = F.regexp_extract(c, r"(\d{8})", 1)
    return F.try_to_date(F.nullif(digits, F.lit("")), "yyyyMMdd")


def event_category(name: Column) -> Column:
    return F.when(F.lower(name).isin(CLOCK_CHANGES), "Time change").otherwise("Holiday")


def unescape_attribute(c: Column) -> Column:
    """The character references that occur in links; ``&amp;`` last."""
    plain = c
    for entity, char in [("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&#x27;", "'"),
                         ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"),
                         ("&#38;", "&"), ("&#x26;", "&"), ("&amp;", "&")]:
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.when(c.contains("&"), plain).otherwise(c)


def unquote(c: Column) -> Column:
    quoted = c.startswith('"') | c.startswith("'")
    return F.when(quoted, F.substr(c, F.lit(2), F.length(c) - 2)).otherwise(c)


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    parts = F.split(path, "/", -1)
    empty = F.array().cast("array<string>")
    # Element 0 is the empty string before the leading slash and is never popped.
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)),
        empty,
        lambda acc, seg: F.when(seg == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(seg == ".", acc)
        .otherwise(F.concat(acc, F.array(seg))),
    )
    slash_end = F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    closed = F.when(joined.endswith("/"), joined).otherwise(F.concat(joined, slash_end))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), closed).otherwise(path)


def page_address(url: Column) -> dict[str, Column]:
    """The parts of a page's address that its links are resolved with."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return {
        "page": F.regexp_extract(url, r"^([^#]*)", 1),
        "bare": F.regexp_extract(url, r"^([^?#]*)", 1),
        "origin": F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1),
        "folder": F.when(path == "", "/").otherwise(F.regexp_extract(path, r"^(.*/)", 1)),
    }


def resolve_link(url: Column, address: dict[str, Column], href: Column) -> Column:
    """Absolute address of a link found on the page ``url`` with that ``page_address``.

    A link that names a host (``http://x/..``, ``//x/..``) or another scheme
    (``mailto:``) stays as it is. ``href`` must have no white space around it. The
    commonest kind, ``/path``, is decided by plain text comparison.
    """
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    href_tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    rooted = F.when(~href.contains("/."), F.concat(address["origin"], href)).otherwise(
        F.concat(address["origin"], _without_dots(href_path), href_tail)
    )
    below = F.concat(address["origin"], _without_dots(F.concat(address["folder"], href_path)), href_tail)
    return (
        F.when(href.startswith("/") & ~href.startswith("//"), rooted)
        .when(href.rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:|//[^/?#])"), href)
        .when(href == "", url)
        .when(href.startswith("#"), F.concat(address["page"], href))
        .when(href.startswith("?"), F.concat(address["bare"], href))
        .when(href.startswith("/"), rooted)
        .otherwise(below)
    )


def file_name(url: Column) -> Column:
    """Last path segment of an address, without query, fragment or parameters."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_extract(path, r"([^/;]*)(?:;[^/]*)?$", 1)
