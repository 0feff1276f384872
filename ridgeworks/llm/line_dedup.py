"""Line deduplication by how many of a site's pages hold a line. All of it is DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeworks.llm.common import whole

# a line is boilerplate when more than this share of its host's pages hold it ...
RATIO = 0.05
# ... and at least so many pages do; one page alone is no evidence
MIN_PAGES = 3

# fixed values: what ends a line, in an order that leaves no script text behind
UNSEEN = r"(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
TAG = r"<[^>]*>"
EDGE = r"^[ \t\r]+|[ \t\r]+$"


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without port or user; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def page_lines(html: Column) -> Column:
    """Non-empty lines of a page: every tag ends a line, scripts, styles and comments are no text."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), UNSEEN, "\n")
    text = F.regexp_replace(text, TAG, "\n")
    lines = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, EDGE, ""))
    return F.filter(lines, lambda x: x != "")


def boilerplate_lines(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines) of the lines that more than ``ratio`` of a host's pages hold.

    ``pages`` has host and lines. A line counts once a page, is counted in the task that reads it
    first, and a hot line or host reaches the shuffle as one row per task. A host has at most
    (mean lines per page / ratio) such lines, so the list is bounded whatever its number of pages.
    """
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    held = (
        pages.select("host", F.explode(F.array_distinct("lines")).alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("held"))
        .filter(F.col("held") >= min_pages)
    )
    often = held.join(totals, "host").filter(F.col("held") > F.col("pages") * ratio)
    return often.groupBy("host").agg(F.collect_list("line").alias("often"), F.first("pages").alias("pages"))


def drop_boilerplate(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Every row of ``pages`` as struct ``row``, with host, n_lines, n_dropped and clean_text.

    ``clean_text`` is the lines that stay, in order, joined by line feeds. A null URL belongs to the
    host '', null HTML has no lines, repeated rows are pages of their own, an empty table gives an
    empty result. Pages meet their host's list by a join on (host, salt): pages are dealt evenly
    over 64 salts, so a host with a third of all pages is spread over as many tasks.
    """
    lined = pages.select(
        whole(pages).alias("row"), host_of(F.col(url)).alias("host"), page_lines(F.col(html)).alias("lines")
    )
    salts = 64
    lists = boilerplate_lines(lined, ratio, min_pages).select(
        "host", "often", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    )
    salted = lined.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    often = F.coalesce("often", F.array().cast("array<string>"))
    stay = F.filter("lines", lambda x: ~F.array_contains(F.col("often"), x))
    return (
        salted.join(lists, ["host", "salt"], "left")
        .select("row", "host", "lines", often.alias("often"))
        .select("row", "host", "lines", stay.alias("stay"))
        .select(
            "row",
            "host",
            F.size("lines").alias("n_lines"),
            (F.size("lines") - F.size("stay")).alias("n_dropped"),
            F.array_join("stay", "\n").alias("clean_text"),
        )
    )
