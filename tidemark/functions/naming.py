"""Table, directory and file names."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

from tidemark.schema import SNAPSHOT_NAME_FORMAT

# Characters that Spark's partitioned writer escapes in directory names, besides control characters.
RESERVED_IN_FOLDERS = "\"#%'*/:=?\\{[]^\x7f"


def encode_table_name(name: Column) -> Column:
    """Table name to directory name; null stays null."""
    return F.translate(name, ":", "~")


def decode_table_name(name: Column) -> Column:
    """Directory name to table name. A ``~`` in the original name cannot be told from a ``:``."""
    return F.translate(name, "~", ":")


def encode_table(name: str) -> str:
    return name.replace(":", "~")


def _unescape(name: Column) -> Column:
    # url_decode reads '+' as a blank, while in paths it stands for itself; most names hold nothing to decode
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(name.contains("%"), decoded).otherwise(name)


def file_name_of(path: Column) -> Column:
    """Last path element of a file URI."""
    return _unescape(F.substring_index(path, "/", -1))


def encoded_table_of_path(path: Column) -> Column:
    """Encoded name of the table a snapshot file URI belongs to, from its directory: ``<name>`` or ``table=<name>``."""
    folder = folder_name_of(path)
    # the hive writer escapes once more inside partition directory names
    return F.when(folder.startswith("table="), _unescape(F.substring(folder, 7, 1 << 30))).otherwise(folder)


def folder_name_of(path: Column) -> Column:
    """Directory name of a file URI, as it is on disk."""
    return _unescape(F.substring_index(F.substring_index(path, "/", -2), "/", 1))


def in_table_folder(path: Column, snapshot: str) -> Column:
    """The file lies directly in a directory of the named snapshot, not deeper."""
    return F.substring_index(path, "/", -3).startswith(f"{snapshot}/")


def file_suffix(key: Column) -> Column:
    """md5 of the first key in a file, in hex; part of the file's name."""
    return F.md5(key)


def snapshot_name(when: Column) -> Column:
    """Snapshot directory name of a timestamp, UTC."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), when.cast("timestamp").cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd-HH-mm-ss")


def snapshot_time(name: Column) -> Column:
    """Timestamp of a snapshot directory name; null when the name has another form."""
    parts = F.split(name, "-")
    iso = F.format_string(
        "%s-%s-%sT%s:%s:%sZ", parts[0], parts[1], parts[2], parts[3], parts[4], parts[5]
    )
    return F.when(name.rlike(r"^\d{4}(-\d{2}){5}$"), iso.try_cast("timestamp"))


def format_snapshot_name(when: datetime) -> str:
    return as_utc(when).strftime(SNAPSHOT_NAME_FORMAT)


def parse_snapshot_name(name: str) -> datetime:
    return datetime.strptime(name, SNAPSHOT_NAME_FORMAT).replace(tzinfo=timezone.utc)


def as_utc(when: datetime) -> datetime:
    """Naive datetimes are taken as UTC."""
    return when.replace(tzinfo=timezone.utc) if when.tzinfo is None else when.astimezone(timezone.utc)
