"""Document attributes taken from the JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schema import INTRINSIC_FIELDS

METADATA_COLUMNS = ["table", "key", "version", "lastUpdateTs", "deleted"]

# The usual form, which Spark's own cast reads as it is.
_PLAIN_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
# Date, optionally a time with a zone; both the extended and the compact form.
_ISO_TIME = (
    r"^(\d{4})-?(\d{2})-?(\d{2})"
    r"(?:T(\d{2}):?(\d{2})(?::?(\d{2})([.,]\d+)?)?(Z|[+-]\d{2}(?::?\d{2})?))?$"
)


def iso_to_millis(text: Column) -> Column:
    """ISO-8601 text to epoch milliseconds; null when it is not such a time. A time of day needs a zone.

    Give it a plain column or one bound by :func:`_let`: the expression refers to its argument many times.
    """

    def part(group: int, default: str) -> Column:
        found = F.regexp_extract(text, _ISO_TIME, group)
        return F.when(found == "", F.lit(default)).otherwise(found)

    zone = F.regexp_replace(part(8, "Z"), r"^([+-]\d{2}):?(\d{2})?$", "$1:$2")
    zone = F.when(zone.endswith(":"), F.concat(zone, F.lit("00"))).otherwise(zone)
    fraction = F.translate(part(7, ".0"), ",", ".")
    rebuilt = F.concat(
        part(1, ""), F.lit("-"), part(2, ""), F.lit("-"), part(3, ""), F.lit("T"),
        part(4, "00"), F.lit(":"), part(5, "00"), F.lit(":"), part(6, "00"), fraction, zone,
    )
    moment = F.when(text.rlike(_PLAIN_TIME), text).when(text.rlike(_ISO_TIME), rebuilt)
    return F.unix_millis(moment.try_cast("timestamp"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _add_columns(df: DataFrame, fields: Column, names: list[str]) -> DataFrame:
    """Add the fields of a struct as columns, computing it once for each row whatever is read or filtered afterwards.

    A generator is what Spark neither copies into later expressions nor pushes a filter below, nor leaves out when its columns are not read.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*others, F.inline_outer(F.array(fields)))


def with_metadata(df: DataFrame, document: str = "value") -> DataFrame:
    """Add ``table, key, version, lastUpdateTs, deleted`` from the top level of a JSON column.

    For each attribute the first occurrence with the right JSON type counts; nested objects are not looked
    into; a fractional version is cut to its whole part. What cannot be found is null. The text is parsed
    once, into variants, so that ``5`` and ``"5"`` stay apart and repeated names are all seen.
    """
    attributes = F.filter(
        F.map_entries(F.from_json(F.col(document), "map<string,variant>")),
        lambda e: e["key"].isin(INTRINSIC_FIELDS),
    )

    def first(found: Column, name: str, of_type, spark_type: str) -> Column:
        hits = F.filter(found, lambda e: (e["key"] == name) & of_type(F.schema_of_variant(e["value"])))
        return F.try_variant_get(F.get(hits, F.lit(0))["value"], "$", spark_type)

    def text(kind: Column) -> Column:
        return kind == "STRING"

    def number(kind: Column) -> Column:
        return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")

    def fields(found: Column) -> Column:
        return F.struct(
            first(found, "~table", text, "string").alias("table"),
            first(found, "~id", text, "string").alias("key"),
            first(found, "~version", number, "bigint").alias("version"),
            _let(first(found, "~lastUpdateAt", text, "string"), iso_to_millis).alias("lastUpdateTs"),
            first(found, "~deleted", lambda kind: kind == "BOOLEAN", "boolean").alias("deleted"),
        )

    return _add_columns(df, _let(attributes, fields), METADATA_COLUMNS)


def is_complete(attributes: list[str] = METADATA_COLUMNS) -> Column:
    """All the attributes were found."""
    complete = F.lit(True)
    for name in attributes:
        complete = complete & F.col(name).isNotNull()
    return complete


def require_complete(df: DataFrame, document: str = "value", attributes: list[str] = METADATA_COLUMNS) -> DataFrame:
    """Fail the job on the first document that lacks an attribute, whatever columns are read afterwards."""
    message = F.concat(
        F.lit("document lacks a required attribute: "), F.coalesce(F.substring(F.col(document), 1, 200), F.lit("null"))
    )
    fields = F.struct(*[F.col(name) for name in METADATA_COLUMNS])
    return _add_columns(df, F.when(is_complete(attributes), fields).otherwise(F.raise_error(message)), METADATA_COLUMNS)


def valid_documents(df: DataFrame) -> DataFrame:
    return df.where(is_complete())


def invalid_documents(df: DataFrame) -> DataFrame:
    return df.where(~is_complete())
