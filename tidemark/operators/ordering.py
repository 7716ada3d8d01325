"""Range partitioning by document."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.schema import DOCUMENT_KEY


def sort_documents(df: DataFrame, partitions: int | None = None, leading: tuple[str, ...] = ()) -> DataFrame:
    """Globally sorted by ``(table, key)`` in that many ranges, after the ``leading`` columns if any.

    Without a number, Spark merges its shuffle partitions to ranges of its advisory size.

    The ranges go by all of them, so a table that holds most rows is spread over many ranges.
    """
    order = [*leading, *DOCUMENT_KEY]
    ranges = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranges.sortWithinPartitions(*order)
