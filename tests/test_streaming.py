"""Streaming behaviour: late rows (G3), restart from checkpoint, upsert, console."""

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from liqspark.operators.windows import sliding_window_agg
from liqspark.sinks.upsert import read_upserted, upsert_writer
from liqspark.streaming.quotes import windowed_quotes
from liqspark.streaming.runner import run_available_now


def _event(ts: str, v: float, bond: int = 1, tg: int = 20) -> str:
    return json.dumps({"id": "1", "bond": str(bond), "tg": str(tg), "bid": str(v), "ask": str(v),
                       "volume_money": str(v), "date": ts[:10], "update_ts": ts, "overturn": "0"})


def _land(folder: str, name: str, lines: list[str], mtime: float) -> None:
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.json"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (mtime, mtime))


def _text_stream(spark, folder, per_trigger=1):
    return spark.readStream.format("text").option("maxFilesPerTrigger", per_trigger).load(folder)


def test_g3_late_rows_one_file_per_batch(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    base = time.time() - 1000
    for i, (ts, v) in enumerate([("2019-10-01T12:00:00", 5), ("2019-10-01T12:00:30", 6),
                                 ("2019-10-01T09:50:00", 7), ("2019-10-01T18:00:00", 1)]):
        _land(src, f"f{i}", [_event(ts, v)], base + 10 * i)
    out = f"{tmp_dir}/out"
    run_available_now(windowed_quotes(_text_stream(spark, src)), out, f"{tmp_dir}/ck")
    rows = spark.read.parquet(out).collect()
    by_sum = {}
    for r in rows:
        by_sum.setdefault(r.volume_money, []).append(r.window_end)
    assert sorted(by_sum) == [7.0, 11.0]
    ends7 = sorted(by_sum[7.0])
    assert len(ends7) == 20
    assert (ends7[0].hour, ends7[0].minute, ends7[-1].minute) == (10, 1, 20)
    ends11 = sorted(by_sum[11.0])
    assert len(ends11) == 30
    assert (ends11[0].hour, ends11[0].minute, ends11[-1].minute) == (12, 1, 30)


def test_restart_from_checkpoint_resumes_state(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    base = time.time() - 1000
    _land(src, "a", [_event("2019-10-01T10:00:00", 1), _event("2019-10-01T10:10:00", 2)], base)
    run_available_now(windowed_quotes(_text_stream(spark, src, 10)), out, ck)
    first = spark.read.parquet(out).count()
    # Second run, same checkpoint: only the new file is read; the state kept from
    # the first run still holds the open windows of the 10:00 / 10:10 rows.
    _land(src, "b", [_event("2019-10-01T10:20:00", 4), _event("2019-10-01T16:00:00", 8)], base + 10)
    run_available_now(windowed_quotes(_text_stream(spark, src, 10)), out, ck)
    got = spark.read.parquet(out)
    # Reference: the same rows as one batch, windows closed by the final watermark.
    batch = spark.createDataFrame([(_event(t, v),) for t, v in [
        ("2019-10-01T10:00:00", 1), ("2019-10-01T10:10:00", 2), ("2019-10-01T10:20:00", 4),
        ("2019-10-01T16:00:00", 8)]], "value string")
    from liqspark.functions.jsonq import parse_quote_json
    expect = sliding_window_agg(parse_quote_json(batch)).where(
        F.col("window_end") <= F.lit("2019-10-01 14:00:00").cast("timestamp"))
    key = ["window_start", "bond", "tg", "date", "volume_money", "cnt"]
    assert first == 0  # nothing closed yet: watermark 08:10
    assert sorted(map(tuple, got.select(key).collect())) == \
        sorted(map(tuple, expect.select(key).collect()))
    assert got.count() == got.dropDuplicates(["window_start", "bond", "tg", "date"]).count()


def test_foreach_batch_upsert_keeps_newest_and_replay_is_noop(spark, tmp_dir):
    from liqspark.functions.jsonq import parse_quote_json
    src, target = f"{tmp_dir}/in", f"{tmp_dir}/table"
    base = time.time() - 1000
    _land(src, "a", [_event("2019-10-01T10:00:00", 1), _event("2019-10-01T10:05:00", 2),
                     _event("2019-10-01T10:00:00", 3, tg=30)], base)
    _land(src, "b", [_event("2019-10-01T09:00:00", 9), _event("2019-10-01T11:00:00", 4, tg=30),
                     _event("2019-10-02T08:00:00", 5)], base + 10)
    stream = parse_quote_json(_text_stream(spark, src)).select("bond", "tg", "date", "bid", "update_ts")
    write = upsert_writer(target)
    run_available_now(stream, None, f"{tmp_dir}/ck", foreach_batch=write)
    got = sorted((r.tg, str(r.date), r.bid) for r in read_upserted(spark, target).collect())
    assert got == [(20, "2019-10-01", 2.0), (20, "2019-10-02", 5.0), (30, "2019-10-01", 4.0)]
    # Replaying a batch changes nothing.
    replay = parse_quote_json(spark.read.text(f"{src}/a.json")).select(
        "bond", "tg", "date", "bid", "update_ts")
    write(replay, 0)
    again = sorted((r.tg, str(r.date), r.bid) for r in read_upserted(spark, target).collect())
    assert again == got


def test_console_sink_runs(spark, tmp_dir):
    from liqspark.sinks.writers import console
    src = f"{tmp_dir}/in"
    _land(src, "a", [_event("2019-10-01T10:00:00", 1)], time.time() - 100)
    from liqspark.functions.jsonq import parse_quote_json
    q = console(parse_quote_json(_text_stream(spark, src)), f"{tmp_dir}/ck")
    try:
        q.processAllAvailable()
        assert q.lastProgress is not None and q.lastProgress["numInputRows"] == 1
    finally:
        q.stop()


def test_stream_equals_batch_filtered_by_watermark(spark):
    from liqspark.plans import catalog
    stream = catalog.REGISTRY["stream_sliding_window"].fn(spark, "/root/testdata/sf0.001")
    batch = catalog.REGISTRY["sliding_window_agg"].fn(spark, "/root/testdata/sf0.001")
    max_ts = spark.read.parquet("/root/testdata/sf0.001/events.parquet").agg(F.max("ts")).first()[0]
    cut = max_ts - dt.timedelta(minutes=120)
    expect = batch.where(F.col("window_end") <= F.lit(cut))
    assert stream.exceptAll(expect).count() == 0
    assert expect.exceptAll(stream).count() == 0


def test_state_partitions_are_chosen_per_query(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _land(src, "a", [_event("2019-10-01T10:00:00", 1)], time.time() - 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run_available_now(windowed_quotes(_text_stream(spark, src)), out, ck, state_partitions=3)
    assert sorted(d for d in os.listdir(f"{ck}/state/0") if d.isdigit()) == ["0", "1", "2"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_upsert_reads_only_touched_partitions(spark, tmp_dir):
    from pyspark.sql import functions as F
    from liqspark.sinks.upsert import upsert_latest
    rows = [(b, 1, dt.date(2019, 10, d), float(b), dt.datetime(2019, 10, d, 10))
            for b in range(5) for d in range(1, 6)]
    df = spark.createDataFrame(rows, "bond long, tg long, date date, bid double, update_ts timestamp")
    target = f"{tmp_dir}/t"
    upsert_latest(df, target)
    batch = spark.createDataFrame([(1, 1, dt.date(2019, 10, 3), 9.0, dt.datetime(2019, 10, 3, 11))],
                                  df.schema)
    upsert_latest(batch, target)
    got = read_upserted(spark, target)
    assert got.count() == 25
    assert got.where("bond = 1 AND date = '2019-10-03'").first().bid == 9.0
    # Only the touched date has moved to the second version's folder, and it alone is read for it.
    from liqspark.sinks.upsert import _manifest
    one, two = (_manifest(spark, target, v) for v in (1, 2))
    assert [k for k in two if one[k] != two[k]] == ["_partition=2019-10-03"]
    files = read_upserted(spark, target, partitions=["2019-10-03"]).inputFiles()
    assert files and all("_partition=2019-10-03" in f and "/data/000000000002-" in f for f in files)


def test_dropped_windows_are_counted(spark, tmp_dir):
    from liqspark.streaming.runner import dropped_by_watermark
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    base, dropped = time.time() - 1000, []
    for k, ts in enumerate(["2019-10-01T12:00:00", "2019-10-01T09:50:00", "2019-10-01T05:00:00"]):
        _land(src, f"f{k}", [_event(ts, k)], base + 10 * k)
        dropped.append(dropped_by_watermark(run_available_now(windowed_quotes(_text_stream(spark, src, 10)), out, ck)))
    assert dropped == [0, 10, 30]


def test_open_windows_are_read_from_state(spark, tmp_dir):
    from liqspark.streaming.runner import state_rows
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _land(src, "a", [_event("2019-10-01T12:00:00", 1), _event("2019-10-01T09:50:00", 2, tg=30)], time.time() - 100)
    run_available_now(windowed_quotes(_text_stream(spark, src)), out, ck)
    held = state_rows(spark, ck).select("key.*", "value.*").collect()
    closed = spark.read.parquet(out).count()
    assert closed == 10 and len(held) == 50 and sorted({r.tg for r in held}) == [20, 30]


def test_published_once_keeps_updates_and_drops_repeats(spark, tmp_dir):
    from liqspark.sources.snapshot import published_once, snapshot_explode, snapshot_stream
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    item = lambda i, ts, **more: {"id": str(i), "emission_id": "5", "trading_ground_id": "1", "update_time": ts, **more}
    page = lambda *items: json.dumps({"count": len(items), "items": items}, indent=1).split("\n")
    base = time.time() - 1000
    polls = [page(item(1, "2019-10-01T10:00:00"), item(2, "2019-10-01T10:00:00"), item(9, "soon")),
             page(item(1, "2019-10-01T10:00:00"), item(2, "2019-10-01T10:05:00"), item(3, "2019-10-01T10:05:00")), page(),
             page(item(1, "2019-10-01T10:00:00"), item(3, "2019-10-01T10:05:00"), item(3, "2019-10-01T10:05:00"))]
    for k, lines in enumerate(polls):
        _land(src, f"p{k}", lines, base + 10 * k)
        run_available_now(published_once(snapshot_explode(snapshot_stream(spark, src))), out, ck)
    got = sorted((r.id, r.update_ts[-8:]) for r in spark.read.parquet(out).collect())
    assert got == [("1", "10:00:00"), ("2", "10:00:00"), ("2", "10:05:00"), ("3", "10:05:00")]


def test_stream_enrichment_without_broadcast_matches(spark, tmp_dir):
    from liqspark.plans import catalog
    from liqspark.streaming.quotes import enriched_quotes
    sf = "/root/testdata/sf0.001"
    metrics, _ = catalog._materialized_metrics(spark, sf)
    outs = {}
    for label, limit in (("broadcast", None), ("merge", 10)):
        out = f"{tmp_dir}/{label}"
        stream = enriched_quotes(catalog._event_stream(spark, sf), metrics, broadcast_max_bytes=limit)
        run_available_now(stream, out, f"{out}/_ck", state_partitions=4)
        outs[label] = spark.read.parquet(out).withColumn("volume_money", F.round("volume_money", 6))
    assert outs["merge"].count() == outs["broadcast"].count() > 0
    assert outs["merge"].exceptAll(outs["broadcast"]).count() == 0
