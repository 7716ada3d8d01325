"""Hand-made inputs and a plain-Python model of the merge."""

import gzip
import json
from pathlib import Path

from tidemark.schema import CHANGE_SCHEMA

TS = "2017-12-11T21:00:45.484Z"


def document(table, key, version=1, text="x", deleted=False, **extra):
    body = {
        "~deleted": deleted,
        "~firstUpdateAt": TS,
        "~id": key,
        "~lastMutateAt": TS,
        "~lastUpdateAt": TS,
        "~signature": "0" * 32,
        "~table": table,
        "~version": version,
        "text": text,
        **extra,
    }
    return json.dumps(body, separators=(",", ":"))


def change(table, key, version, day, text="new", ts=0, uid=None, deleted=False):
    uid = uid or f"{table}-{key}-{version}-{ts}-{day}"
    value = None if deleted else bytearray(document(table, key, version, text), "utf-8")
    return (uid, table, key, version, ts, deleted, 0, value, day)


def change_frame(spark, rows):
    return spark.createDataFrame(rows, CHANGE_SCHEMA)


def write_log(spark, rows, path):
    from tidemark.sinks.change_log import append_change_log

    append_change_log(change_frame(spark, rows), str(path), 2)


def write_file(root, name, table, file, lines, trailing_newline=True):
    folder = Path(root) / name / table.replace(":", "~")
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(lines) + ("\n" if trailing_newline else "")
    raw = text.encode("utf-8")
    (folder / file).write_bytes(gzip.compress(raw) if file.endswith(".gz") else raw)


def point_at(root, name):
    Path(root).mkdir(parents=True, exist_ok=True)
    (Path(root) / "_LATEST").write_text(name)


def read_back(root, name):
    """{table: sorted lines} of a snapshot, read without Spark."""
    found = {}
    base = Path(root) / name
    for folder in sorted(p for p in base.iterdir() if p.is_dir()):
        table = folder.name.removeprefix("table=").replace("~", ":")
        for file in sorted(folder.iterdir()):
            if file.name.startswith((".", "_")):
                continue
            raw = file.read_bytes()
            raw = gzip.decompress(raw) if file.name.endswith(".gz") else raw
            found.setdefault(table, []).extend(line for line in raw.decode("utf-8").split("\n") if line)
    return {table: sorted(lines) for table, lines in found.items()}


def model_merge(prior, changes, live, days, copy_unmodified=True):
    """Next snapshot as a sorted list of (table, key, value).

    ``prior`` is a list of (table, key, value) in position order; ``changes`` are rows as in :func:`change`.
    """
    newest = {}
    updated = set()
    for uid, table, key, version, ts, deleted, _, content, day in changes:
        if day not in days:
            continue
        updated.add(table)
        rank = (version, ts, uid)
        if (table, key) not in newest or rank > newest[table, key][0]:
            newest[table, key] = (rank, deleted, content)
    result = [
        (table, key, bytes(content).decode("utf-8"))
        for (table, key), (_, deleted, content) in newest.items()
        if table in live and not deleted
    ]
    seen = set()
    for table, key, value in prior:
        if table not in live:
            continue
        if copy_unmodified and table not in updated:
            result.append((table, key, value))
        elif (table, key) not in newest and (table, key) not in seen:
            seen.add((table, key))
            result.append((table, key, value))
    return sorted(result)
