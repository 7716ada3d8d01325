"""Fixed column layouts shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# The change-log layout on disk. Names, types and nullability are part of the file format.
CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("updateId", T.StringType(), False),
        T.StructField("table", T.StringType(), False),
        T.StructField("key", T.StringType(), False),
        T.StructField("version", T.LongType(), False),
        T.StructField("lastUpdateTs", T.LongType(), False),
        T.StructField("deleted", T.BooleanType(), False),
        T.StructField("encoding", T.IntegerType(), False),
        T.StructField("content", T.BinaryType(), True),
        T.StructField("pollDate", T.StringType(), False),
    ]
)
CHANGE_PARTITIONS = ["pollDate", "table"]

# The document attributes every document carries at its top level.
INTRINSIC_FIELDS = ["~table", "~id", "~version", "~lastUpdateAt", "~deleted"]

# Payload encoding codes.
TEXT = 0

# Table status bits.
NEITHER = 0
EXISTS = 1
HAS_UPDATES = 2

# Formats and defaults that other readers of the files rely on.
POINTER_FILE = "_LATEST"
SNAPSHOT_NAME_FORMAT = "%Y-%m-%d-%H-%M-%S"
POLL_DAY_FORMAT = "%Y%m%d"
DOCUMENTS_PER_FILE = 100_000
FILES_PER_COPY_TASK = 20
BATCH_INTERVAL = "5 minutes"
BATCH_PARTITIONS = 8

DOCUMENT_KEY = ["table", "key"]
# Total order of the changes of one document: the first three decide, the id only makes ties deterministic.
CHANGE_ORDER = ["version", "lastUpdateTs", "updateId"]
# Columns that place a snapshot line; whichever of them a frame has are used, in this order.
POSITION_COLUMNS = ["file", "block", "seq", "line"]
