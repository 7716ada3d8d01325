"""Which tables are live, updated, dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.identity import has_updates, table_exists
from tidemark.schema import EXISTS, HAS_UPDATES


def updated_tables(changes: DataFrame) -> DataFrame:
    """Distinct tables with a change. On a partitioned log this reads no data columns."""
    return changes.select("table").distinct()


def table_presence(live: DataFrame, updated: DataFrame) -> DataFrame:
    """Full outer join of the two name lists: ``table, live, updated``."""
    lhs = live.select("table").distinct().withColumn("live", F.lit(True))
    rhs = updated.select("table").distinct().withColumn("updated", F.lit(True))
    no = F.lit(False)
    return lhs.join(rhs, "table", "full_outer").select(
        "table", F.coalesce("live", no).alias("live"), F.coalesce("updated", no).alias("updated")
    )


def table_status_flags(live: DataFrame, updated: DataFrame) -> DataFrame:
    """``table, status`` with the bits of both lists or-ed per table: one shuffle, combined before it."""
    flagged = live.select("table", F.lit(EXISTS).alias("status")).unionByName(
        updated.select("table", F.lit(HAS_UPDATES).alias("status"))
    )
    return flagged.groupBy("table").agg(F.bit_or("status").alias("status"))


def classify_tables(live: DataFrame, changes: DataFrame, copy_unmodified: bool = True) -> DataFrame:
    """``table, live, updated, action``: ``merge``, ``copy`` (live, no change) or ``drop`` (changed, not live).

    ``copy_unmodified=False`` sends every live table through the merge.
    """
    status = table_status_flags(live, changes)
    flags = status.select(
        "table", table_exists(F.col("status")).alias("live"), has_updates(F.col("status")).alias("updated")
    )
    merged = F.col("updated") | F.lit(not copy_unmodified)
    action = F.when(~F.col("live"), "drop").when(merged, "merge").otherwise("copy")
    return flags.withColumn("action", action)


def dropped_tables(live: DataFrame, changes: DataFrame) -> DataFrame:
    """Tables that have changes but are not live, sorted. Their changes are left out of the next snapshot."""
    return updated_tables(changes).join(live.select("table").distinct(), "table", "left_anti").orderBy("table")


def unmodified_tables(live: DataFrame, changes: DataFrame) -> DataFrame:
    """Live tables without any change."""
    return live.select("table").distinct().join(updated_tables(changes), "table", "left_anti")
