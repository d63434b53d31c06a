"""Windows whose state holds buckets: what is stored, the exact end of a window, nulls, joins before the copies."""

import json
import os

from pyspark.sql import functions as F

from liqspark.functions.jsonq import parse_quote_json
from liqspark.operators.windows import enriched_windows, sliding_window_agg
from liqspark.streaming.held_windows import STATE
from liqspark.streaming.quotes import windowed_quotes
from liqspark.streaming.runner import run_available_now


def _event(ts, v, bond=1, date="2019-10-01"):
    return json.dumps({"id": "1", "bond": str(bond), "tg": "20", "bid": v, "ask": "NaN" if v is None else v,
                       "volume_money": v, "date": date, "update_ts": f"2019-10-01T{ts}", "overturn": "0"})


def _land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_state_holds_a_bucket_a_quote_and_windows_close_at_their_end(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    lines = [_event("10:00:00", "1"), _event("10:00:20", None, date=None), _event("12:01:00", "2", bond=2)]
    _land(src, "a", lines)
    run_available_now(windowed_quotes(spark.readStream.text(src)), out, ck, state_partitions=2)
    # The watermark is 10:01 exactly: the windows that end then are closed.
    want = sliding_window_agg(parse_quote_json(spark.createDataFrame([(x,) for x in lines], "value string"))).where("window_end <= '2019-10-01 10:01:00'")
    got = spark.read.parquet(out).select(*want.columns)
    assert got.count() == 2 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    held = spark.read.format("statestore").option("stateVarName", STATE).load(ck)
    assert held.agg(F.sum(F.size("value.m"))).first()[0] == 3  # 30 rows a quote before


def test_metrics_are_joined_before_runs_are_copied(spark):
    quotes = parse_quote_json(spark.createDataFrame([(_event("10:00:00", "1"),), (_event("10:07:00", "2"),)], "value string"))
    metrics = spark.createDataFrame([(1, "XS1", 0.5, 1.0)], "id long, isin string, bid_ask_spread_relative_median double, bid_ask_spread_relative_rank double")
    got = enriched_windows(quotes, metrics, broadcast_max_bytes=0)
    assert got.count() == 37 and got.where("isin = 'XS1'").count() == 37
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sequence(") < plan.index("Join")
