"""Readers take any Spark format with the fixed schema; validation splits off bad rows."""

from stride.session import scratch_path
from stride.sources import fixtures as fx
from stride.sources import tables
from tests.conftest import SF_SMALL


def test_labelled_csv_and_live_json_equal_parquet(spark):
    ev = fx.events(spark, SF_SMALL)
    lab = fx.labelled(ev)
    live = fx.live(ev)
    p_csv, p_json, p_pq = (scratch_path(spark, n) for n in ("lab-csv", "live-json", "lab-pq"))
    lab.write.option("header", "true").csv(p_csv)
    live.write.json(p_json)
    lab.write.parquet(p_pq)
    a = tables.read_labelled(spark, p_csv, "csv", {"header": "true"})
    b = tables.read_labelled(spark, p_pq)
    assert a.schema == b.schema == tables.LABELLED_SCHEMA
    assert sorted(a.collect()) == sorted(b.collect())
    c = tables.read_live(spark, p_json, "json")
    assert c.schema == tables.LIVE_SCHEMA and c.count() == ev.count()


def test_split_valid_sends_nulls_to_side_output(spark):
    df = spark.createDataFrame([(1, "Walking", 5, 1.0, 2.0, 3.0), (1, None, 6, 1.0, 2.0, 3.0),
                                (1, "Walking", None, 1.0, 2.0, 3.0)], tables.LABELLED_SCHEMA)
    ok, bad = tables.split_valid(df, [f.name for f in tables.LABELLED_SCHEMA.fields])
    assert ok.count() == 1 and bad.count() == 2


def test_column_map_and_time_unit(spark, tmp_path):
    from stride.sources.tables import read_labelled

    rows = [(1, "Walking", 5, 1.0, 2.0, 3.0)]
    path = str(tmp_path / "labelled")
    spark.createDataFrame(rows, "user_id long, activity string, timestamp long, acc_x double, acc_y double, acc_z double").write.parquet(path)
    got = read_labelled(spark, path, columns={"ts_ns": "timestamp"}, time_unit="ms").first()
    assert got.ts_ns == 5_000_000 and got.activity == "Walking"


def test_live_units_and_columns(spark, tmp_path):
    """One time column in seconds, under other names, from JSON; a time beyond the long range is missing."""
    path = str(tmp_path / "live")
    rows = [("u", 5, 1.0, 2.0, 3.0), ("u", 1 << 62, 1.0, 2.0, 3.0)]
    spark.createDataFrame(rows, "uid string, at long, x double, y double, z double").write.json(path)
    got = tables.read_live(spark, path, "json", columns={"user_id": "uid", "timestamp": "at", "timestamp_long": "at"}, time_unit="s")
    assert got.schema == tables.LIVE_SCHEMA
    assert sorted((r.timestamp or 0, r.timestamp_long or 0) for r in got.collect()) == [(0, 0), (5_000_000_000, 5_000_000_000)]


def test_message_bytes(spark):
    """Binary values of two partitions: identifiers keep both apart and in order; bad bytes reach the dead letters."""
    import datetime as dt

    from stride.operators import requests as rq

    u = "00000000-0000-0000-0000-000000000001"
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(p, o, at, v) for p, o, v in [(0, 7, f"{u},1,5".encode()), (1, 7, f"{u},2,6".encode()), (0, 8, b"\xff\xfe,1,2"), (1, 8, None), (1, 9, b"\xc3")]]
    records = spark.createDataFrame(rows, "partition int, offset long, timestamp timestamp, value binary")
    got = tables.bus_messages(records)
    assert got.schema["value"].dataType.simpleString() == "string"
    parsed, dead = rq.parse_requests(got)
    ids = {r.request_id: (r.valid_user, r.start_ts, r.request_ts) for r in parsed.collect()}
    assert ids == {7: (True, 1, 1_704_067_200_000_000_000), (1 << 40) + 7: (True, 2, 1_704_067_200_000_000_000), 8: (False, 1, 1_704_067_200_000_000_000)}
    assert {r.request_id: r.dead_reason for r in dead.collect()} == {(1 << 40) + 8: "empty", (1 << 40) + 9: "too_few_fields"}
