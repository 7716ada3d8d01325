"""Inputs of the registered queries, derived from the given tables, and the same views as SQL."""

from __future__ import annotations

from datetime import datetime
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.dates import window_days
from tidemark.functions.metadata import with_metadata
from tidemark.session import scratch_path
from tidemark.sinks.change_log import append_change_log, to_change_rows
from tidemark.sinks.snapshot import name_files, publish_snapshot, write_snapshot
from tidemark.sources.snapshot import snapshot_files

PRIOR_TIME = datetime(2024, 1, 10, 6)
NEW_TIME = datetime(2024, 1, 20)
NEXT_TIME = datetime(2024, 1, 25)
PRIOR_NAME = "2024-01-10-06-00-00"
DAYS = window_days(PRIOR_TIME, NEW_TIME)

BULK_PRIOR_TIME = datetime(1997, 1, 1)
BULK_NEW_TIME = datetime(1998, 1, 1)
BULK_DAYS = window_days(BULK_PRIOR_TIME, BULK_NEW_TIME)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # days and formatted times below are UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "concat('u', event_id) AS updateId",
        "concat('t', user_id % 6) AS `table`",
        "string(user_id) AS key",
        "bigint(day(ts)) AS version",
        "unix_millis(timestamp(ts)) AS lastUpdateTs",
        "event_id % 10 = 0 AS deleted",
        "0 AS encoding",
        "CASE WHEN event_id % 10 <> 0 THEN encode(props, 'UTF-8') END AS content",
        "date_format(ts, 'yyyyMMdd') AS pollDate",
    )


def prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('t', c_custkey % 8) AS `table`", "string(c_custkey) AS key", "c_name AS value"
    )


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t0 to t8 without t5: some merged, some unmodified, one empty, one dropped."""
    return (
        table(spark, sf_dir, "customer")
        .selectExpr("concat('t', c_custkey % 9) AS `table`")
        .where("`table` <> 't5'")
        .distinct()
    )


def bulk_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, '-', "
        "bigint(round(l_extendedprice * 100))) AS updateId",
        "concat('o', l_orderkey % 16) AS `table`",
        "string(l_orderkey) AS key",
        "bigint(l_linenumber) AS version",
        "unix_millis(timestamp(l_shipdate)) AS lastUpdateTs",
        "l_returnflag = 'R' AS deleted",
        "0 AS encoding",
        "CASE WHEN l_returnflag <> 'R' THEN encode(string(l_partkey), 'UTF-8') END AS content",
        "date_format(l_shipdate, 'yyyyMMdd') AS pollDate",
    )


def bulk_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('o', o_orderkey % 18) AS `table`", "string(o_orderkey) AS key", "o_orderpriority AS value"
    )


def bulk_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "orders").selectExpr("concat('o', o_orderkey % 18) AS `table`")
    return names.where("`table` <> 'o3'").distinct()


def repeated_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders filed under their customer: every key occurs many times."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('t', o_custkey % 8) AS `table`",
        "string(o_custkey) AS key",
        "o_orderpriority AS file",
        "o_orderkey AS line",
        "concat('order ', o_orderkey) AS value",
    )


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes as whole JSON documents, with look-alike attributes inside a nested object."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """to_json(named_struct(
             'about', named_struct('~id', 'inner', '~table', 'inner', '~version', -1),
             '~deleted', event_id % 10 = 0,
             '~id', string(user_id),
             '~lastUpdateAt', date_format(timestamp(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
             '~table', concat('t', user_id % 6),
             '~version', day(ts),
             'body', props)) AS value""",
    )


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prior snapshot as whole JSON documents."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('t', c_custkey % 8) AS `table`",
        "string(c_custkey) AS key",
        """to_json(named_struct(
             '~deleted', false,
             '~id', string(c_custkey),
             '~lastUpdateAt', '2023-12-31T00:00:00.000Z',
             '~table', concat('t', c_custkey % 8),
             '~version', 1,
             'body', c_name)) AS value""",
    )


def supplier_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('nation:', s_nationkey) AS `table`",
        "string(s_suppkey) AS key",
        """to_json(named_struct(
             '~deleted', false,
             '~id', string(s_suppkey),
             '~lastUpdateAt', '2024-01-15T00:00:00.000Z',
             '~table', concat('nation:', s_nationkey),
             '~version', 1,
             'body', s_name)) AS value""",
    )


@lru_cache(maxsize=None)
def _written(application: str, sf_dir: str, build, label: str) -> str:
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, label)
    build(spark, sf_dir, path)
    return path


def _once(spark: SparkSession, sf_dir: str, build) -> str:
    """Path of files written by ``build``, shared by the queries of one application."""
    return _written(spark.sparkContext.applicationId, sf_dir, build, build.__name__.strip("_"))


def _event_log(spark, sf_dir, path):
    append_change_log(changes(spark, sf_dir), path)


def event_log(spark: SparkSession, sf_dir: str) -> str:
    """The changes as a change log on disk."""
    return _once(spark, sf_dir, _event_log)


def _shards(spark, sf_dir, path):
    documents = table(spark, sf_dir, "customer").selectExpr(
        "concat('shard~', c_custkey div 500) AS `table`", "c_custkey", "c_name AS value"
    )
    # a blank line in front of every tenth name; blank lines are not counted
    lines = documents.withColumn(
        "value", F.expr("explode(CASE WHEN c_custkey % 10 = 0 THEN array('', value) ELSE array(value) END)")
    )
    ordered = lines.repartition("table").sortWithinPartitions("table", "c_custkey", "value")
    ordered.select("table", "value").write.partitionBy("table").text(f"{path}/{PRIOR_NAME}")


def shards(spark: SparkSession, sf_dir: str) -> str:
    """A snapshot with one file per table of at most five hundred customers, in key order."""
    return _once(spark, sf_dir, _shards)


def _landing(spark, sf_dir, path):
    # one line per poll of up to fifty events, with fields that readers skip
    polls = event_documents(spark, sf_dir).groupBy(F.expr("event_id div 50")).agg(
        F.concat(
            F.lit("["),
            F.array_join(
                F.collect_list(
                    F.expr("concat('{\"eventKey\":\"e', event_id, '\",\"tags\":[{\"x\":1}],\"content\":', value, '}')")
                ),
                ",",
            ),
            F.lit("]"),
        ).alias("value")
    )
    polls.select("value").write.text(path)


def landing(spark: SparkSession, sf_dir: str) -> str:
    """The event documents as landed envelope files."""
    return _once(spark, sf_dir, _landing)


def _customer_root(spark, sf_dir, path):
    write_snapshot(customer_documents(spark, sf_dir), f"{path}/{PRIOR_NAME}")
    publish_snapshot(spark, path, PRIOR_NAME)


def customer_root(spark: SparkSession, sf_dir: str) -> str:
    """Root of a published snapshot of the customer documents."""
    return _once(spark, sf_dir, _customer_root)


def _document_log(spark, sf_dir, path):
    # spread before they are parsed: a small file is read by few tasks
    events = with_metadata(event_documents(spark, sf_dir).repartition("event_id"))
    append_change_log(to_change_rows(events, received=F.timestamp_millis(F.col("lastUpdateTs"))), path)


def document_log(spark: SparkSession, sf_dir: str) -> str:
    """The event documents as a change log."""
    return _once(spark, sf_dir, _document_log)


def _supplier_root(spark, sf_dir, path):
    write_snapshot(supplier_documents(spark, sf_dir), f"{path}/{PRIOR_NAME}")
    publish_snapshot(spark, path, PRIOR_NAME)


def supplier_root(spark: SparkSession, sf_dir: str) -> str:
    """Root of a published snapshot that holds none of the changed tables."""
    return _once(spark, sf_dir, _supplier_root)


def hidden_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer documents in tables named ``__system:n`` and ``.n``."""
    name = "CASE WHEN c_custkey % 3 = 0 THEN concat('.', c_custkey % 6) ELSE concat('__system:', c_custkey % 4) END"
    return table(spark, sf_dir, "customer").selectExpr(
        f"{name} AS `table`",
        "string(c_custkey) AS key",
        f"""to_json(named_struct(
             '~deleted', false,
             '~id', string(c_custkey),
             '~lastUpdateAt', '2023-12-31T00:00:00.000Z',
             '~table', {name},
             '~version', 1,
             'body', c_name)) AS value""",
    )


def _hidden_root(spark, sf_dir, path):
    target = f"{path}/{PRIOR_NAME}"
    write_snapshot(hidden_documents(spark, sf_dir), target)
    name_files(snapshot_files(spark, path, PRIOR_NAME), target)
    publish_snapshot(spark, path, PRIOR_NAME)


def hidden_root(spark: SparkSession, sf_dir: str) -> str:
    """Root of a published snapshot of those documents, in the plain layout."""
    return _once(spark, sf_dir, _hidden_root)


def _hidden_log(spark, sf_dir, path):
    changed = with_metadata(
        hidden_documents(spark, sf_dir).where("key % 5 = 0").selectExpr(
            "replace(replace(value, '2023-12-31', '2024-01-15'), 'Customer', 'Changed') AS value"
        ).repartition("value")
    )
    append_change_log(to_change_rows(changed, received=F.timestamp_millis(F.col("lastUpdateTs"))), path)


def hidden_log(spark: SparkSession, sf_dir: str) -> str:
    """A change of every fifth of those documents, in the first run's window."""
    return _once(spark, sf_dir, _hidden_log)


FIRST_EVENT = r'"eventKey":"e(\d+)"'


def _bad_landing(spark, sf_dir, path):
    pages = spark.read.text(landing(spark, sf_dir))
    first = F.regexp_extract("value", FIRST_EVENT, 1).cast("long")
    pages.select(F.when(first % 500 < 50, F.expr("substr(value, 1, length(value) - 1)")).otherwise(F.col("value")).alias("value")).write.text(path)


def bad_landing(spark: SparkSession, sf_dir: str) -> str:
    """The landed pages, every tenth without its closing bracket."""
    return _once(spark, sf_dir, _bad_landing)


def _mixed_landing(spark, sf_dir, path):
    pages = spark.read.text(bad_landing(spark, sf_dir))
    pages.select(F.replace("value", F.lit('"~deleted":true'), F.lit('"~deleted":"true"')).alias("value")).write.text(path)


def mixed_landing(spark: SparkSession, sf_dir: str) -> str:
    """The same pages, with deletes whose mark has the wrong type."""
    return _once(spark, sf_dir, _mixed_landing)


# The same views for the reference SQL.
SQL_VIEWS = """
changes AS (
  SELECT 'u' || event_id AS uid, 't' || (user_id % 6) AS tbl, CAST(user_id AS VARCHAR) AS k,
         CAST(day(ts) AS BIGINT) AS version, epoch_us(ts) // 1000 AS last_ts, event_id % 10 = 0 AS deleted,
         CASE WHEN event_id % 10 <> 0 THEN props END AS content, props, strftime(ts, '%Y%m%d') AS poll_date
  FROM events),
prior AS (
  SELECT 't' || (c_custkey % 8) AS tbl, CAST(c_custkey AS VARCHAR) AS k, c_name AS value
  FROM customer),
live AS (SELECT DISTINCT 't' || (c_custkey % 9) AS tbl FROM customer WHERE c_custkey % 9 <> 5),
win AS (SELECT * FROM changes WHERE poll_date >= '20240110' AND poll_date < '20240120'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tbl, k ORDER BY version DESC, last_ts DESC, uid DESC) AS rn FROM win),
latest AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1 AND tbl IN (SELECT tbl FROM live)),
merged_tables AS (SELECT DISTINCT tbl FROM win WHERE tbl IN (SELECT tbl FROM live))
"""

BULK_SQL_VIEWS = """
changes AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
           || CAST(round(l_extendedprice * 100) AS BIGINT) AS uid,
         'o' || (l_orderkey % 16) AS tbl, CAST(l_orderkey AS VARCHAR) AS k,
         CAST(l_linenumber AS BIGINT) AS version, epoch_us(l_shipdate) // 1000 AS last_ts, l_returnflag = 'R' AS deleted,
         CAST(l_partkey AS VARCHAR) AS content, strftime(l_shipdate, '%Y%m%d') AS poll_date
  FROM lineitem),
prior AS (
  SELECT 'o' || (o_orderkey % 18) AS tbl, CAST(o_orderkey AS VARCHAR) AS k, o_orderpriority AS value FROM orders),
live AS (SELECT DISTINCT 'o' || (o_orderkey % 18) AS tbl FROM orders WHERE o_orderkey % 18 <> 3),
win AS (SELECT * FROM changes WHERE poll_date >= '19970101' AND poll_date < '19980101'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tbl, k ORDER BY version DESC, last_ts DESC, uid DESC) AS rn FROM win),
latest AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1 AND tbl IN (SELECT tbl FROM live))
"""
