"""Boilerplate lines by site-relative frequency.

For each site (host), the pages that contain a line are divided by the site's
pages; lines above a ratio are boilerplate and go from every page of the site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATIO = 0.05
#: A line on fewer pages of its site than this is kept whatever its ratio, so that small sites keep their text.
LEAST_PAGES = 5


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def boilerplate(lines: DataFrame, pages: DataFrame, ratio: float, least_pages: int) -> DataFrame:
    """Lines (site, h1, h2) over the ratio; ``lines`` has one row a page and distinct line."""
    often = lines.groupBy("_site", "_h1", "_h2").agg(F.count(F.lit(1)).alias("_pages")).where(F.col("_pages") >= least_pages)
    totals = pages.where(F.col("_site").isNotNull()).groupBy("_site").agg(F.count(F.lit(1)).alias("_all"))
    return often.join(totals, "_site").where(F.col("_pages") > F.col("_all") * ratio).select("_site", "_h1", "_h2")


def drop_site_lines(pages: DataFrame, site: Column, id_col: str = "doc_id", text_col: str = "text", ratio: float = RATIO,
                    least_pages: int = LEAST_PAGES) -> DataFrame:
    """``pages`` with boilerplate lines taken from the text, and ``n_dropped_lines``.

    Lines are parted by line feeds and compared whole, by 96 bits of hash. A
    page counts once for each distinct line. Lines without a non-space are not
    counted and stay. Pages without a site, null and empty texts stay as they
    are (0 dropped); a page may become empty but is never dropped. Each
    repeated row is a page. Other columns pass through, but for one named
    ``n_dropped_lines``.

    Counts are summed before the shuffle, so a line on a third of all pages is
    one row a task. Lines of pages meet the (few) boilerplate lines, and only
    pages that have some are joined with their texts.
    """
    names = [c for c in pages.columns if c != "n_dropped_lines"]
    others = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names if c != text_col])
    rows = pages.select(others.alias("_row"), F.col(text_col).alias("_text"), site.alias("_site"), F.xxhash64(F.col(id_col), site).alias("_k1"),
                        F.xxhash64(F.col(text_col)).alias("_k2"))
    parted = F.explode(F.array_distinct(F.split("_text", "\n", -1))).alias("_line")
    lines = rows.where(F.col("_site").isNotNull()).select("_site", "_k1", "_k2", parted).where(F.col("_line").rlike(r"\S")) \
        .select("_site", "_k1", "_k2", F.xxhash64("_line").alias("_h1"), F.hash("_line").alias("_h2"))
    bad = boilerplate(lines, rows, ratio, least_pages)
    marked = lines.join(bad, ["_site", "_h1", "_h2"]).groupBy("_k1", "_k2") \
        .agg(F.collect_set(F.struct("_h1", "_h2")).alias("_bad"))
    out = rows.join(marked, ["_k1", "_k2"], "left")
    all_lines = F.split("_text", "\n", -1)
    kept = F.filter(all_lines, lambda x: ~F.array_contains("_bad", F.struct(F.xxhash64(x).alias("_h1"), F.hash(x).alias("_h2"))))
    some = F.col("_bad").isNotNull()
    text = F.when(some, F.array_join("_kept", "\n")).otherwise(F.col("_text"))
    return out.withColumn("_kept", F.when(some, kept)).select(
        *[text.alias(c) if c == text_col else F.col(f"_row.`{c}`") for c in names],
        F.when(some, F.size(all_lines) - F.size("_kept")).otherwise(0).cast("bigint").alias("n_dropped_lines"))
