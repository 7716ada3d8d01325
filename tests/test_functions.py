"""Column functions against hand-made values."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from support import document

from tidemark.functions import dates, identity, metadata, naming, payload
from tidemark.schema import EXISTS, HAS_UPDATES, NEITHER

DECOYS = document(
    "review:sample", "004ce43c", version=5,
    about={"~id": "product::x", "~table": "catalog:other:", "~version": 9, "~deleted": True},
    order=["~id", {"~id": "y"}],
).replace("2017-12-11T21:00:45.484Z", "2017-03-24T16:18:14.550Z")


def attributes(spark, *texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")
    rows = metadata.with_metadata(frame).orderBy("n").collect()
    return [(r["table"], r["key"], r["version"], r["lastUpdateTs"], r["deleted"]) for r in rows]


def test_intrinsics_of_a_document_with_nested_look_alikes(spark):
    assert attributes(spark, DECOYS) == [("review:sample", "004ce43c", 5, 1490372294550, False)]


def test_first_correctly_typed_occurrence_counts(spark):
    got = attributes(
        spark,
        '{"~id":5,"~id":"b","~id":"c","~version":"9","~version":7,"~version":8,"~table":null,"~table":"t",'
        '"~lastUpdateAt":0,"~lastUpdateAt":"2017-03-24T18:18:14.550+02:00","~deleted":"true","~deleted":true}',
        '{"~id":"a","~version":5.9,"~table":"t","~lastUpdateAt":"2017-03-24","~deleted":false}',
        '{"~id":"a","~version":1e3,"~table":"","~lastUpdateAt":"soon","~deleted":false}',
        '["~id"]', "no json", None, "",
    )
    assert got[0] == ("t", "b", 7, 1490372294550, True)
    assert got[1] == ("t", "a", 5, 1490313600000, False)
    assert got[2] == ("", "a", 1000, None, False)
    assert got[3:] == [(None,) * 5] * 4


@pytest.mark.parametrize("missing", ["~id", "~table", "~version", "~lastUpdateAt", "~deleted"])
def test_a_missing_attribute_is_an_error_or_set_aside(spark, missing):
    broken = document("t", "k").replace(f'"{missing}"', '"other"')
    frame = metadata.with_metadata(spark.createDataFrame([(document("t", "k"),), (broken,)], "value string"))
    assert [r["value"] for r in metadata.invalid_documents(frame).collect()] == [broken]
    assert [r["value"] for r in metadata.valid_documents(frame).collect()] == [document("t", "k")]
    with pytest.raises(Exception, match="lacks a required attribute"):
        metadata.require_complete(frame).select("key").collect()


def test_iso_times(spark):
    cases = {
        "2017-03-24T16:18:14.550Z": 1490372294550,
        "20170324T161814.550Z": 1490372294550,
        "2017-03-24T18:18:14.550+0200": 1490372294550,
        "2017-03-24T18:18:14.5509+02": 1490372294550,
        "2017-03-24T16:18Z": 1490372280000,
        "2017-03-24": 1490313600000,
        "1969-12-31T23:59:59.999Z": -1,
        "2017-03-24T16:18:14": None,
        "2017-13-24T16:18:14Z": None,
        "today": None,
        None: None,
    }
    frame = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r["t"]: r["ms"] for r in frame.select("t", metadata.iso_to_millis(F.col("t")).alias("ms")).collect()}
    assert got == cases


def test_payload_round_trip(spark):
    texts = ['{"text":"' + "abcdefghijklmnopqrstuvwxyz0123456789" * 1000 + '"}', "", "äöü€😀", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, t string")
    packed = frame.select("n", payload.text_to_bytes(F.col("t")).alias("p"), F.lit(0).alias("e"))
    rows = packed.withColumn("back", payload.decode_payload(F.col("e"), F.col("p"))).orderBy("n").collect()
    assert [r["back"] for r in rows] == texts
    assert rows[3]["p"] is None and bytes(rows[2]["p"]) == texts[2].encode("utf-8")


@pytest.mark.parametrize("code", [1, 2])
def test_unknown_encoding_fails(spark, code):
    frame = spark.createDataFrame([(code, bytearray(b"x"))], "e int, p binary")
    with pytest.raises(Exception, match=f"unsupported encoding code {code}"):
        frame.select(payload.decode_payload(F.col("e"), F.col("p"))).collect()


def test_required_attributes_are_checked_whatever_is_read(spark):
    frame = spark.createDataFrame([("t", None, 1, 1, False, "text")], "table string, key string, version long, lastUpdateTs long, deleted boolean, value string")
    with pytest.raises(Exception, match="lacks a required attribute"):
        metadata.require_complete(frame).select("version").collect()


def test_table_names(spark):
    frame = spark.createDataFrame([("a:b:c",), ("plain",), (None,), ("",)], "t string")
    encoded = frame.select("t", naming.encode_table_name(F.col("t")).alias("e"))
    rows = encoded.withColumn("d", naming.decode_table_name(F.col("e"))).collect()
    assert [(r["e"], r["d"]) for r in rows] == [("a~b~c", "a:b:c"), ("plain", "plain"), (None, None), ("", "")]


def test_snapshot_names(spark):
    when = datetime(2018, 1, 7, 3, 4, 5, tzinfo=timezone.utc)
    assert naming.format_snapshot_name(when) == "2018-01-07-03-04-05"
    assert naming.format_snapshot_name(when.astimezone(timezone(timedelta(hours=-8)))) == "2018-01-07-03-04-05"
    assert naming.parse_snapshot_name("2018-01-07-03-04-05") == when
    with pytest.raises(ValueError):
        naming.parse_snapshot_name("latest")
    frame = spark.createDataFrame([("2018-01-07-03-04-05",), ("nonsense",)], "n string")
    seconds = [r[0] for r in frame.select(F.unix_seconds(naming.snapshot_time(F.col("n")))).collect()]
    assert seconds == [int(when.timestamp()), None]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_days_are_utc_in_any_session_zone(spark, zone):
    frame = spark.createDataFrame([(1515283199999,), (1515283200000,), (-1,)], "ms long")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        when = F.timestamp_millis("ms")
        rows = frame.select(dates.poll_date(when), naming.snapshot_name(when)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [tuple(r) for r in rows] == [
        ("20180106", "2018-01-06-23-59-59"), ("20180107", "2018-01-07-00-00-00"), ("19691231", "1969-12-31-23-59-59"),
    ]


WINDOWS = [
    (datetime(2018, 1, 7), datetime(2018, 1, 8), ["20180107"]),
    (datetime(2018, 1, 7, 23), datetime(2018, 1, 8, 0, 0, 1), ["20180107", "20180108"]),
    (datetime(2018, 1, 7, 6), datetime(2018, 1, 7, 18), ["20180107"]),
    (datetime(2018, 2, 27), datetime(2018, 3, 2), ["20180227", "20180228", "20180301"]),
    (datetime(2018, 1, 9), datetime(2018, 1, 7), []),
]


@pytest.mark.parametrize("prior, new, days", WINDOWS)
def test_window_days(spark, prior, new, days):
    assert dates.window_days(prior, new) == days
    frame = spark.createDataFrame([(prior, new)], "p timestamp_ntz, n timestamp_ntz").select(
        F.col("p").cast("timestamp").alias("p"), F.col("n").cast("timestamp").alias("n")
    )
    assert frame.select(dates.poll_dates(F.col("p"), F.col("n"))).first()[0] == days


def test_window_lookback():
    assert dates.window_days(datetime(2018, 1, 7, 5), datetime(2018, 1, 8), 2) == ["20180105", "20180106", "20180107"]


def test_snapshot_order():
    dates.check_snapshot_order(datetime(2018, 1, 7), datetime(2018, 1, 7, 0, 0, 1))
    for new in (datetime(2018, 1, 7), datetime(2018, 1, 6)):
        with pytest.raises(ValueError):
            dates.check_snapshot_order(datetime(2018, 1, 7), new)


def test_update_ids(spark):
    frame = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("ab", "c"), (None, "abc")], "a string, b string")
    ids = [r[0] for r in frame.select(identity.update_id(F.col("a"), F.col("b"))).collect()]
    assert ids[0] == ids[2] and len(set(ids)) == 3
    texts = spark.createDataFrame([(ids[0],), ("0-0-0-0-A",), ("no",), ("1-2-3-4",)], "t string")
    assert [r[0] for r in texts.select(identity.is_update_id(F.col("t"))).collect()] == [True, True, False, False]
    with pytest.raises(Exception, match="malformed update id no"):
        texts.where("t = 'no'").select(identity.parse_update_id(F.col("t"))).collect()


def test_status_bits(spark):
    frame = spark.createDataFrame([(EXISTS, HAS_UPDATES), (EXISTS, None), (None, HAS_UPDATES), (NEITHER, None)], "a int, b int")
    both = frame.select(identity.combine_status(F.col("a"), F.col("b")).alias("s"))
    rows = both.select("s", identity.table_exists(F.col("s")), identity.has_updates(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [(3, True, True), (1, True, False), (2, False, True), (0, False, False)]
