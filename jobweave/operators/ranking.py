"""Global numbering, keep-first, and skew-safe lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_ROW = "_row_in_partition"
_PARTITION_BITS = 33  # layout of monotonically_increasing_id: partition above, row below


def _placed(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` range-sorted in parallel and checkpointed, with ``_part`` and ``_row`` inside the partition."""
    sorted_rows = df.orderBy(*order).withColumn(_ROW, F.monotonically_increasing_id())
    placed = cut_lineage(sorted_rows)
    return placed.withColumn("_part", F.shiftright(F.col(_ROW), _PARTITION_BITS)).withColumn(
        _ROW, F.col(_ROW).bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    )


def _before(*partition: str):
    return Window.partitionBy(*partition).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)


def renumber(df: DataFrame, *order: Column | str, name: str = "stt", start: int = 1) -> DataFrame:
    """Consecutive numbers in global order, without a single-task window over the rows.

    Rows are range-sorted in parallel and written to the checkpoint folder with
    their place inside the partition; the partition sizes (one row per
    partition) give each partition its offset.  ``order`` must be total.
    """
    placed = _placed(df.drop(name), *order)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    offset = F.coalesce(F.sum("_size").over(_before()), F.lit(0)).alias("_offset")
    numbered = placed.join(F.broadcast(sizes.select("_part", offset)), "_part")
    number = F.col(_ROW) + F.col("_offset") + F.lit(start)
    return numbered.withColumn(name, number).drop("_part", "_offset", _ROW)


def keep_first(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in ``order``.

    An aggregate rather than a window: rows of a hot key are reduced to one per
    partition before the shuffle.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    named = [F.col(k).alias(f"_k{i}") if isinstance(k, str) else k.alias(f"_k{i}") for i, k in enumerate(keys)]
    place = [F.col(o) if isinstance(o, str) else o for o in order]
    first = df.groupBy(*named).agg(F.min_by(row, F.struct(*place)).alias("_row"))
    return first.select("_row.*")


def lookup(df: DataFrame, values: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """Left join to one row per key, reading each input once.

    A hot or null key of ``df`` is a skewed partition of a left join, which adaptive execution splits.
    ``weight`` names a column of ``values`` that only counts rows and is left out.
    """
    extra = [c for c in values.columns if c not in keys and c != weight]
    return df.join(values.select(*keys, *extra), keys, "left").select(*df.columns, *extra)


def sample_rows(df: DataFrame, row_id: str, n: int = 500, seed: int = 42) -> DataFrame:
    """A repeatable sample: the ``n`` rows whose seeded hash is smallest."""
    return df.orderBy(F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f":{seed}"))), row_id).limit(n)


def head_rows(df: DataFrame, row_id: str, n: int = 1000) -> DataFrame:
    return df.orderBy(row_id).limit(n)


def sample_values(df: DataFrame, column: str, row_id: str, n: int = 3) -> DataFrame:
    """First ``n`` non-null values of a column."""
    picked = df.filter(F.col(f"`{column}`").isNotNull()).orderBy(row_id).limit(n)
    return picked.select(F.lit(column).alias("column"), F.col(row_id).alias("row_id"), F.col(f"`{column}`").cast("string").alias("value"))


def page_streaks(
    pages: DataFrame, site: str, page: str, new_count: str, limit: int = 10, reported: str | None = None
) -> DataFrame:
    """How many pages in a row up to each page brought nothing new, and where a crawl stops.

    The streak is the distance to the last page with news; a crawl stops at the
    first page whose streak exceeds ``limit``.  With ``reported``, the column
    of the total that a page states, it also stops once so many were ``found``
    as the site's first page stated (``total``; none unless positive).  A site
    may fill many partitions of the range sort: each part counts on its own, and
    one row per site and part carries the counts and the last news forward.
    """
    placed = _placed(pages, site, page)
    local = Window.partitionBy("_part", site).orderBy(_ROW)
    brought = F.coalesce(F.col(new_count).cast("bigint"), F.lit(0))
    counted = placed.withColumn("_n", F.row_number().over(local)).withColumn("_found", F.sum(brought).over(local))
    news = F.when(F.col(new_count) > 0, F.col("_n"))
    states = F.col(reported).cast("bigint") if reported else F.lit(None).cast("bigint")
    parts = counted.groupBy(site, "_part").agg(
        F.count("*").alias("_size"), F.max(news).alias("_news"), F.sum(brought).alias("_sum"),
        F.min_by(F.struct(states.alias("total")), _ROW).alias("_first"),
    )
    offset = F.coalesce(F.sum("_size").over(_before(site)), F.lit(0))
    parts = parts.withColumn("_offset", offset)
    carried = F.coalesce(F.max(F.col("_news") + F.col("_offset")).over(_before(site)), F.lit(0))
    found_before = F.coalesce(F.sum("_sum").over(_before(site)), F.lit(0)).alias("_found_before")
    total = F.first("_first").over(Window.partitionBy(site).orderBy("_part"))["total"].alias("total")
    parts = parts.select(site, "_part", "_offset", carried.alias("_carried"), found_before, total)
    ordered = counted.withColumn("_last", F.max(news).over(local)).join(parts, [site, "_part"])
    last = F.coalesce(F.col("_last") + F.col("_offset"), F.col("_carried"))
    streaks = ordered.withColumn("streak", F.col("_n") + F.col("_offset") - last).withColumn(
        "found", F.col("_found") + F.col("_found_before")
    )
    silent = F.col("streak") > limit
    if not reported:
        return streaks.select(*pages.columns, "streak", silent.alias("stops"))
    reached = F.coalesce((F.col("total") > 0) & (F.col("found") >= F.col("total")), F.lit(False))
    return streaks.select(*pages.columns, "streak", "found", "total", (silent | reached).alias("stops"))


def crawl_progress(
    pages: DataFrame, links: DataFrame, site: str, page: str, link: str, reported: str, limit: int = 10
) -> DataFrame:
    """``page_streaks`` of the pages of a crawl, with ``new_count``: the links that no earlier page of the site had.

    ``pages`` has one row a page, ``links`` one row a link of a page; a page without links brings nothing.
    """
    first = links.filter(F.col(link).isNotNull()).groupBy(site, link).agg(F.min(page).alias(page))
    new = first.groupBy(site, page).agg(F.count("*").alias("new_count"))
    rows = pages.join(new, [site, page], "left").withColumn("new_count", F.coalesce("new_count", F.lit(0)))
    return page_streaks(rows, site, page, "new_count", limit, reported)
