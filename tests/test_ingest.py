"""Landing files in batch and as a stream."""

import json
from pathlib import Path

import pytest

from tiffin.operators.staging import stg_customer_events, stg_promotion
from tiffin.schemas import EVENTS, RAW_COLUMNS
from tiffin.sources.raw import read_raw_csv, read_raw_events
from tiffin.streaming.ingest import ingest_stream

PROMOTIONS = RAW_COLUMNS["promotion"].replace(" ", ",") + "\n"


def put(folder, name, text):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text(text)


def test_csv_quotes_null_tokens_and_short_lines(spark, work):
    put(
        f"{work}/promotion",
        "a.csv",
        PROMOTIONS
        + '1,"A ""big"", one",35,2022-11-03 08:15:00,2022-12-01 08:15:00,90,Trial,Kochi\n'
        + "2,NULL,null,,\"\",x,New\n",
    )
    put(f"{work}/promotion", "b.csv", PROMOTIONS + "3,P3,10.5,2023-02-07,bad,1e2,Null,Pune\n")
    raw = read_raw_csv(spark, f"{work}/promotion", "promotion")
    assert {f.dataType.simpleString() for f in raw.schema.fields} == {"string"}
    got = {r.promo_id: tuple(r)[1:] for r in raw.collect()}
    assert got["1"][0] == 'A "big", one'
    assert got["2"] == (None, None, None, None, "x", "New", None)
    assert got["3"][5] == "Null"
    staged = {r.promo_id: r for r in stg_promotion(raw).collect()}
    assert (staged[2].discount_percent, staged[2].max_discount_amt, staged[3].max_discount_amt) == (0, 0, 100)
    assert staged[3].end_date is None


def test_malformed_lines(spark, work):
    put(f"{work}/promotion", "a.csv", PROMOTIONS + "1,P1,40,,,150,Loyal,Delhi\n2,P2\n3,P3,40,,,150,Loyal,Delhi,extra\n")
    kept = read_raw_csv(spark, f"{work}/promotion", "promotion", rejects="bad_line").collect()
    assert [(r.promo_id, r.promo_code, r.bad_line) for r in sorted(kept, key=lambda r: r.promo_id)] == [
        ("1", "P1", None),
        ("2", "P2", "2,P2"),
        ("3", "P3", "3,P3,40,,,150,Loyal,Delhi,extra"),
    ]
    assert [r.promo_id for r in read_raw_csv(spark, f"{work}/promotion", "promotion", mode="DROPMALFORMED").collect()] == ["1"]
    with pytest.raises(Exception, match="MALFORMED"):
        read_raw_csv(spark, f"{work}/promotion", "promotion", mode="FAILFAST").collect()


def event(i, kind, **metadata):
    return json.dumps({"event_id": i, "customer_id": 7, "event_type": kind, "event_ts": "2024-01-01 10:00:00", "metadata": metadata})


def test_events_keep_unknown_keys_and_survive_bad_lines(spark, work):
    lines = [event(1, "SEARCH", search_query="pizza", device_os="iOS", app_version="4"), event(2, "PROMO_VIEW", promo_code="X"), "{bad"]
    put(f"{work}/events", "e.json", "\n".join(lines) + "\n")
    raw = read_raw_events(spark, f"{work}/events")
    assert raw.schema.simpleString() == "struct<event_raw:variant>"
    got = sorted(map(tuple, stg_customer_events(raw).collect()), key=str)
    assert len(got) == 3
    assert (None,) * 7 in got
    assert {(r[0], r[4], r[5]) for r in got} == {(1, "pizza", "iOS"), (2, None, None), (None, None, None)}


def test_an_id_that_is_no_number_raises_only_in_strict_mode(spark, work):
    put(f"{work}/events", "e.json", '{"event_id":"abc","customer_id":1}\n')
    raw = read_raw_events(spark, f"{work}/events")
    assert stg_customer_events(raw, strict=False).first().event_id is None
    try:
        stg_customer_events(raw).collect()
    except Exception as err:
        assert "abc" in str(err) or "INVALID_VARIANT_CAST" in str(err)
    else:
        raise AssertionError("a bad id passed")


def test_stream_loads_each_file_once(spark, work):
    def run():
        ingest_stream(spark, f"{work}/in", "promotion", f"{work}/out", f"{work}/ckpt").awaitTermination()
        return sorted((r.promo_id, r.promo_code) for r in spark.read.parquet(f"{work}/out").collect())

    put(f"{work}/in", "a.csv", PROMOTIONS + "1,P1,40,,,150,Loyal,Delhi\n2,NULL,40,,,150,Loyal,Delhi\n")
    assert run() == [("1", "P1"), ("2", None)]
    assert run() == [("1", "P1"), ("2", None)]
    put(f"{work}/in", "b.csv", PROMOTIONS + "3,P3,40,,,150,Loyal,Delhi\n")
    assert run() == [("1", "P1"), ("2", None), ("3", "P3")]
    stamps = spark.read.parquet(f"{work}/out").select("_ingest_file", "_ingest_ts").collect()
    assert {Path(r._ingest_file).name for r in stamps} == {"a.csv", "b.csv"} and all(r._ingest_ts for r in stamps)


def test_stream_of_events(spark, work):
    put(f"{work}/in", "a.json", event(1, "SEARCH", search_query="q") + "\n{bad\n")
    ingest_stream(spark, f"{work}/in", EVENTS, f"{work}/out", f"{work}/ckpt", max_files=1).awaitTermination()
    raw = spark.read.schema("event_raw variant").parquet(f"{work}/out")
    assert sorted((r.event_id, r.search_query) for r in stg_customer_events(raw.filter("event_raw is not null")).collect()) == [(1, "q")]
    assert raw.count() == 2


FEEDBACK = "feedback_id,order_id,customer_id,rating,comment,sentiment_score,created_at\n"


def test_quoted_line_breaks_stay_in_one_record_in_batch_and_stream(spark, work):
    put(f"{work}/feedback", "a.csv", FEEDBACK + '1,10,7,4,"late\nbut ""ok""",0.5,2024-01-01 10:00:00\n2,11\n3,12,7,5,fine,0.9,2024-01-01 11:00:00\n')
    want = [("1", 'late\nbut "ok"', "0.5", None), ("2", None, None, "2,11"), ("3", "fine", "0.9", None)]

    def seen(df):
        return sorted((r.feedback_id, r.comment, r.sentiment_score, r.bad) for r in df.collect())

    assert seen(read_raw_csv(spark, f"{work}/feedback", "customer_feedback", rejects="bad")) == want
    ingest_stream(spark, f"{work}/feedback", "customer_feedback", f"{work}/raw", f"{work}/cp", rejects="bad").awaitTermination()
    assert seen(spark.read.parquet(f"{work}/raw")) == want
    split = read_raw_csv(spark, f"{work}/feedback", "customer_feedback", multi_line=False)
    assert split.count() == 4
