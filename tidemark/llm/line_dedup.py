"""Line dedup: drop lines that many documents share, except in one document.

Lines are exploded to keys and hashed to 128 bits; the distinct documents of each hash are counted with partial
aggregation, so a line that a third of all documents hold costs one row per document once and then one count per task.
The positions that a document loses are gathered by document (never more than its own lines) and joined back, and the
lines between them are put together in order. Lines themselves never travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: str | Column) -> Column:
    """The text cut at line feeds; null or empty: one empty line."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, ASCII letters lower-cased."""
    bare = F.btrim(line, F.lit(_SPACE))
    # lower() is the same on text that is all ASCII, and much cheaper
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def key_hash(key: Column) -> Column:
    """128 bits as two 64-bit hashes of different seeds."""
    return F.struct(F.xxhash64(key).alias("h"), F.xxhash64(F.lit(7), key).alias("g"))


def _hashes(lines: Column, min_chars: int) -> Column:
    """Hash of each line, null for a key that is too short to count."""
    return F.transform(F.transform(lines, line_key), lambda key: F.when(F.length(key) >= min_chars, key_hash(key)))


def _between(lines: str, drop: str) -> Column:
    """The lines at other than the sorted positions ``drop``: the slices between them, in one pass."""
    after = F.concat(F.array(F.lit(-1)), F.col(drop))
    before = F.concat(F.col(drop), F.array(F.size(lines)))
    gaps = F.arrays_zip(after.alias("after"), before.alias("before"))
    return F.flatten(F.transform(gaps, lambda gap: F.slice(F.col(lines), gap["after"] + 2, gap["before"] - gap["after"] - 1)))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``row`` (struct of the columns in ``keep``, default all), ``n_lines``, ``n_dropped``, ``kept_text``; one per document.

    A key of at least ``min_chars`` code points that at least ``min_docs`` distinct ids hold loses all its lines except in
    the document with the largest id. Null and empty texts are one empty line, which stays. Repeated rows of an
    id count once and all keep or lose the same lines. Rows without an id do not count; they lose lines like other rows.
    """
    carried = F.struct(*[F.col(f"`{name}`") for name in (docs.columns if keep is None else keep)])
    rows = docs.select(carried.alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # rows of one id may differ in text
    rows = rows.withColumn("content", key_hash(F.coalesce("text", F.lit(""))))
    lines = rows.select("id", "content", F.posexplode(_hashes(lines_of("text"), min_chars)).alias("at", "key")).where("key is not null")
    shared = lines.groupBy("key").agg(F.count_distinct("id").alias("docs"), F.max("id").alias("last")).where(F.col("docs") >= min_docs)
    drops = lines.join(shared, "key").where(~F.col("id").eqNullSafe(F.col("last")))
    drops = drops.groupBy(F.col("id").alias("_id"), F.col("content").alias("_content")).agg(F.sort_array(F.collect_set("at")).alias("drop"))
    joined = rows.join(drops, F.col("id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content")), "left")
    joined = joined.select("row", lines_of("text").alias("lines"), F.coalesce("drop", F.array().cast("array<int>")).alias("drop"))
    kept = F.array_join(_between("lines", "drop"), "\n")
    return joined.select("row", F.size("lines").cast("long").alias("n_lines"), F.size("drop").cast("long").alias("n_dropped"), kept.alias("kept_text"))
