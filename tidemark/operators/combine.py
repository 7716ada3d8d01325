"""Bringing newest changes and the prior snapshot together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schema import DOCUMENT_KEY, DOCUMENTS_PER_FILE


def all_documents(newest: DataFrame, prior: DataFrame) -> DataFrame:
    """Full outer join on ``(table, key)``; ``has_change`` and ``has_prior`` say where a document is.

    Both sides must hold a key at most once, as the newest and first-copy picks leave them.
    """
    lhs = newest.withColumn("has_change", F.lit(True))
    rhs = prior.withColumn("has_prior", F.lit(True))
    no = F.lit(False)
    return lhs.join(rhs, DOCUMENT_KEY, "full_outer").withColumns(
        {"has_change": F.coalesce("has_change", no), "has_prior": F.coalesce("has_prior", no)}
    )


def split_changed(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("has_change"))


def split_unchanged(documents: DataFrame) -> DataFrame:
    return documents.where(~F.col("has_change"))


def unchanged_documents(prior: DataFrame, changed: DataFrame, small: bool = False) -> DataFrame:
    """Prior documents without any change; versions are never compared.

    ``small`` says that the caller has measured the changed keys; then the prior rows are not shuffled at all.
    """
    keys = changed.select(*DOCUMENT_KEY)
    return prior.join(F.broadcast(keys) if small else keys, DOCUMENT_KEY, "left_anti")


def merge_counts(documents: DataFrame) -> DataFrame:
    """Documents with a change and documents only in the prior snapshot, as one row."""
    return documents.agg(
        F.count_if(F.col("has_change")).alias("changed"), F.count_if(~F.col("has_change")).alias("carried")
    )


def fetch_by_location(lines: DataFrame, locations: DataFrame, strict: bool = True) -> DataFrame:
    """Text of the lines at ``(table, file, line)``. A location that does not exist fails the job, or is null."""
    at = ["table", "file", "line"]
    found = locations.select(*at).join(lines.select(*at, "value", F.lit(True).alias("_found")), at, "left")
    if strict:
        where = F.concat_ws(":", *[F.col(c).cast("string") for c in at])
        found = found.withColumn(
            "value",
            F.when(F.col("_found"), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no such line "), where))),
        )
    return found.drop("_found")


def snapshot_file_plan(documents: DataFrame, documents_per_file: int = DOCUMENTS_PER_FILE) -> DataFrame:
    """``table, documents, files``: how many files of the target size each table needs."""
    counted = documents.groupBy("table").agg(F.count(F.lit(1)).alias("documents"))
    return counted.withColumn("files", files_for(F.col("documents"), documents_per_file))


def files_for(documents: Column, documents_per_file: int = DOCUMENTS_PER_FILE) -> Column:
    """Whole number of files that hold so many documents, in integer arithmetic."""
    size = F.lit(documents_per_file).cast("bigint")
    return F.call_function("div", documents + size - 1, size)
