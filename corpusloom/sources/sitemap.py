"""Sitemaps: location lists and the frontier of page URLs."""

from __future__ import annotations

import re
import sys
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import dom as D
from corpusloom.functions.urls import authority

# The parsing function travels to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 1 << 16  # bytes fed to the parser at once
# Fixed value: how locations are found in text that is not XML.
LOOSE_LOC = r"(?i)<loc>\s*([^<\s]+)\s*</loc>"


def locations(xml: str | None) -> list[str]:
    """Stripped locations of one document at any depth, in the namespace of its root; text that is not XML is searched.

    The document is pulled through the parser in pieces and what has been read is let go, so a large sitemap is never a tree.
    """
    if not xml:
        return []
    found: list[str] = []
    wanted, root = None, None
    parser = ElementTree.XMLPullParser(["start", "end"])
    data = xml.encode("utf-8", "surrogatepass")
    try:
        for at in range(0, len(data), PIECE):
            parser.feed(data[at:at + PIECE])
            for event, element in parser.read_events():
                if root is None:
                    root, wanted = element, element.tag.rpartition("}")[0] + "}loc" if element.tag[0] == "{" else "loc"
                elif event == "end" and element is not root:
                    if element.tag == wanted and element.text:
                        found.append(element.text.strip())
                    element.clear()
        parser.close()
    except (ElementTree.ParseError, LookupError, ValueError):
        return re.findall(LOOSE_LOC, xml)
    return found


@F.pandas_udf(T.ArrayType(T.StringType()))
def _locations(xml: pd.Series) -> pd.Series:
    return xml.map(locations)


def sitemap_locs(sitemaps: DataFrame) -> DataFrame:
    """``(sitemap_url, pos, loc)`` of every document."""
    return D.item_rows(sitemaps.withColumn("_locs", _locations("xml")), "sitemap_url", "_locs", "pos", "loc")


def discover_frontier(sitemaps: DataFrame, is_index: Column, site_host: str | None = None) -> DataFrame:
    """Sorted distinct page URLs reachable through the index documents.

    ``sitemaps`` is ``(sitemap_url, status, xml)``. An index names child sitemaps, a
    child names pages; both must lie on the site (``site_host``, or the host of the
    index itself). There is exactly one level of nesting.
    """
    usable = sitemaps.where((F.col("status") == 200) & (F.col("xml") != ""))
    host = F.lower(F.lit(site_host)) if site_host else F.expr(authority("sitemap_url"))
    named = (sitemap_locs(usable.where(is_index))
             .where(F.expr(authority("loc")) == host)
             .select(F.col("loc").alias("sitemap_url")).distinct())
    children = usable.join(named, "sitemap_url", "left_semi")
    return (sitemap_locs(children)
            .where(F.expr(authority("loc")) == host)
            .select(F.col("loc").alias("url")).distinct().orderBy("url"))


def require_frontier(frontier: DataFrame) -> DataFrame:
    """Fail when nothing was discovered."""
    if frontier.isEmpty():
        raise ValueError("no URLs discovered from the sitemap index")
    return frontier
