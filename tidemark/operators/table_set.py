"""Restricting wide frames to a set of tables without shuffling them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.naming import decode_table_name, encode_table, encode_table_name

# Up to this many names go into the plan as a literal list, which also prunes partitions.
LITERAL_NAMES = 1_000
# Beyond that a name list of at most this size is broadcast; a larger one is joined as Spark sees fit.
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class TableSet:
    """A set of table names: as literals when provably few, else as a frame of distinct names."""

    frame: DataFrame
    names: tuple[str, ...] | None = None
    broadcast: bool = False

    @staticmethod
    def of(tables: DataFrame, literal_names: int = LITERAL_NAMES, broadcast_bytes: int = BROADCAST_BYTES) -> "TableSet":
        """Measure ``tables`` and choose the form. Runs jobs over the names alone; never collects more than the limit."""
        frame = tables.select("table").distinct()
        names = [row[0] for row in frame.limit(literal_names + 1).collect()]
        if len(names) <= literal_names:
            return TableSet(frame, tuple(sorted(names)))
        # row overhead of a hash relation is counted with each name
        size = frame.agg(F.sum(F.octet_length("table") + F.lit(64))).first()[0]
        return TableSet(frame, None, size <= broadcast_bytes)

    @staticmethod
    def by_action(
        status: DataFrame, literal_names: int = LITERAL_NAMES, broadcast_bytes: int = BROADCAST_BYTES
    ) -> dict[str, "TableSet"]:
        """The sets of tables to ``merge`` and to ``copy`` from ``table, action`` rows, few of them in one job."""
        wanted = status.where(F.col("action").isin("merge", "copy")).select("table", "action")
        frames = {action: wanted.where(F.col("action") == action) for action in ("merge", "copy")}
        rows = wanted.limit(literal_names + 1).collect()
        if len(rows) <= literal_names:
            return {
                action: TableSet(frame.select("table"), tuple(sorted(r["table"] for r in rows if r["action"] == action)))
                for action, frame in frames.items()
            }
        return {action: TableSet.of(frame, literal_names, broadcast_bytes) for action, frame in frames.items()}

    def _other_side(self) -> DataFrame:
        return F.broadcast(self.frame) if self.broadcast else self.frame

    def keep(self, df: DataFrame) -> DataFrame:
        if self.names is not None:
            return df.where(F.col("table").isin(*self.names)) if self.names else df.where(F.lit(False))
        return df.join(self._other_side(), "table", "left_semi")

    def drop(self, df: DataFrame) -> DataFrame:
        if self.names is not None:
            return df.where(~F.col("table").isin(*self.names)) if self.names else df
        return df.join(self._other_side(), "table", "left_anti")

    def keep_folders(self, df: DataFrame) -> DataFrame:
        """Keep rows whose ``folder`` is the encoded name of one of the tables, and add the ``table``.

        Going from names to folders keeps a name with ``~`` apart from its look-alike with ``:``.
        """
        folder = F.col("folder")
        if self.names is None:
            named = self.frame.select(encode_table_name(F.col("table")).alias("folder"), "table")
            return df.join(F.broadcast(named) if self.broadcast else named, "folder")
        if not self.names:
            return df.where(F.lit(False)).withColumn("table", folder)
        table = decode_table_name(folder)
        for name in self.names:
            if "~" in name:
                table = F.when(folder == encode_table(name), F.lit(name)).otherwise(table)
        return df.where(folder.isin(*[encode_table(name) for name in self.names])).withColumn("table", table)

    def none(self) -> "TableSet":
        """The empty set."""
        return TableSet(self.frame.where(F.lit(False)), ())

    def minus(self, other: "TableSet") -> "TableSet":
        if self.names is not None and other.names is not None:
            names = tuple(n for n in self.names if n not in set(other.names))
            return TableSet(other.drop(self.frame), names)
        return TableSet(other.drop(self.frame), None, self.broadcast)

    def is_empty(self) -> bool:
        return self.names is not None and not self.names
