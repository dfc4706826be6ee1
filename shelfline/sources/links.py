"""Archive link discovery and download work list, as jobs over pages.

``discover_links`` extracts every anchor ``href`` ending in a suffix
(case-insensitive), resolves it against the page URL, de-duplicates and
orders descending.  ``incremental_worklist`` keeps links whose file is not
present yet, or whose date is on/after a force date.
"""

from __future__ import annotations

import html
import re
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfline.session import ship_package

_COMMENT = r"(?s)<!--.*?(?:-->|$)"
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
# An anchor's href: other attributes before it are skipped whole, so neither
# data-href nor an href inside another attribute's value counts.
_ANCHOR = (r"""(?is)<a(?:\s+(?!href\s*=)[^\s=>"'/]+(?:\s*=\s*""" + _VALUE + r""")?)*\s+href\s*=\s*(""" + _VALUE + ")")
# A character reference in an attribute: numbers with or without a semicolon,
# names as far as they go.
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*[;=]?)")


def _dereference(found: re.Match) -> str:
    """What a reference stands for: by number, by exact name, else itself.

    (Before "=" a name is a parameter of a query, not a reference.)
    """
    ref = found[0]
    return html.unescape(ref) if ref.startswith("&#") or ref[1:] in html5 else ref


@F.pandas_udf(StringType())
def unescape_html(text: pd.Series) -> pd.Series:
    """Decode the character references of attribute values; bad ones never raise.

    All names of the standard and any number (zero, surrogates and what is
    beyond the last character give U+FFFD): the standard library's tables, which
    as an expression would be thousands of literals.
    """
    return text.map(lambda x: _REFERENCE.sub(_dereference, x), na_action="ignore")


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` on page ``base``.

    absolute (``scheme://``) -> as is; ``//host/..`` -> base scheme;
    ``/path`` -> base origin + path; ``?q`` -> base without query;
    ``#f`` -> base without fragment; otherwise relative to the base folder.
    """
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    no_frag = F.regexp_replace(base, r"#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    path_part = F.regexp_replace(no_query, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    folder = F.regexp_replace(path_part, r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
             .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
             .when(href.startswith("/"), F.concat(origin, href))
             .when(href.startswith("?"), F.concat(no_query, href))
             .when(href.startswith("#"), F.concat(no_frag, href))
             .when(href == "", no_frag)
             .otherwise(F.concat(origin, folder, href)))


def remove_dot_segments(url: Column) -> Column:
    """Drop ``.`` segments and fold ``..`` ones, however many; never above the root."""
    origin = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    tail = F.substring(url, F.length(origin) + F.length(path) + 1, F.length(url))
    segments = F.split(path, "/")
    folded = F.aggregate(
        F.slice(segments, F.lit(2), F.size(segments)), F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done).otherwise(F.concat(done, F.array(s))))
    # A path that ends in a dot segment names a folder.
    folder = F.element_at(segments, -1).isin(".", "..") & (F.size(folded) > 0)
    clean = F.concat(F.lit("/"), F.array_join(folded, "/"), F.when(folder, F.lit("/")).otherwise(F.lit("")))
    return F.when((origin != "") & (path != ""), F.concat(origin, clean, tail)).otherwise(url)


def discover_links(pages: DataFrame, suffix: str = ".zip", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Distinct absolute links ending in ``suffix`` (case-insensitive), descending.

    Anchors inside comments do not count; values may be quoted or not;
    character references are decoded; relative links are resolved against
    the page URL.
    """
    ship_package(pages.sparkSession)
    shown = F.regexp_replace(F.col(html_col), _COMMENT, "")
    found = F.explode(F.regexp_extract_all(shown, F.lit(_ANCHOR), 1))
    hrefs = pages.select(F.col(url_col).alias("base"), found.alias("href"))
    quoted = F.col("href").startswith('"') | F.col("href").startswith("'")
    bare = F.when(quoted, F.substring(F.col("href"), F.lit(2), F.length("href") - 2)).otherwise(F.col("href"))
    hrefs = hrefs.select("base", unescape_html(bare).alias("href"))
    # The ending is that of the value as written; a URL then has neither line
    # breaks and tabs nor blanks before it.
    hrefs = hrefs.filter(F.lower(F.col("href")).endswith(suffix.lower()))
    hrefs = hrefs.withColumn("href", F.regexp_replace(F.regexp_replace("href", r"[\t\r\n]", ""), r"^[\x00-\x20]+", ""))
    links = hrefs.select(remove_dot_segments(resolve_url(F.col("base"), F.col("href"))).alias("link")).distinct()
    return links.orderBy(F.col("link").desc())


def link_file_name(link: Column) -> Column:
    """Last path segment of a URL (query and fragment removed)."""
    return F.regexp_extract(F.regexp_replace(link, r"[?#].*$", ""), r"([^/]*)$", 1)


def incremental_worklist(links: DataFrame, existing_names: DataFrame, force_from: str = "",
                         suffix: str = ".zip") -> DataFrame:
    """Links to fetch: file not present yet, or its date (the stem) >= force date."""
    named = links.withColumn("file_name", link_file_name(F.col("link")))
    named = named.withColumn("file_date", F.regexp_replace("file_name", f"(?i){re.escape(suffix)}$", ""))
    have = existing_names.select(F.col("file_name").alias("_have")).distinct()
    j = named.join(have, named.file_name == have._have, "left")
    keep = F.col("_have").isNull()
    if force_from:
        keep = keep | (F.col("file_date") >= F.lit(force_from))
    return j.filter(keep).select("link", "file_name", "file_date").orderBy(F.col("link").desc())
