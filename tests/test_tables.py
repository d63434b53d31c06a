"""Dated metrics table, bucketed joins, reject counts in the job that reads the feed, chained windows."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from liqspark.operators import clean
from liqspark.schemas import METRICS, RAW_EXCHANGE, rejects, split_quarantine
from liqspark.sinks import bucketed, writers


def _metrics(spark, ids):
    rows = [(i, f"XS{i}", dt.datetime(2010, 1, 1), None, 1.0, 0.1 * i, i / 9) for i in ids]
    return spark.createDataFrame(rows, METRICS)


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_day_whatever_was_written_last(spark, tmp_dir):
    path = f"{tmp_dir}/days"
    for anchor, ids in (("20191005", [1, 2]), ("20191007", [3]), ("20191006", [4, 5]), ("20191007", [6, 7])):
        writers.write_metrics_day(_metrics(spark, ids), path, anchor)
    newest = writers.read_newest_metrics(spark, path)
    assert newest.schema.names == [*METRICS.names, "anchor_date"]
    assert sorted((r.id, r.anchor_date) for r in newest.collect()) == [(6, "20191007"), (7, "20191007")]
    assert sorted(r.id for r in writers.read_newest_metrics(spark, path, upto="20191006").collect()) == [4, 5]
    assert writers.read_newest_metrics(spark, path, upto="20180101").count() == 0
    assert writers.read_metrics_days(spark, path).count() == 6
    with pytest.raises(ValueError):
        writers.write_metrics_day(_metrics(spark, [1]), path, "2019-10-05")


def test_newest_day_is_a_partition_filter(spark, tmp_dir):
    path = f"{tmp_dir}/days"
    writers.write_metrics_day(_metrics(spark, [1]), path, "20191005")
    plan = _final_plan(writers.read_newest_metrics(spark, path))
    assert "PartitionFilters: [isnotnull(anchor_date" in plan and "= Subquery" in plan
    # The subquery reads no column of the data.
    assert "ReadSchema: struct<>" in plan


def _sides(spark, tmp_dir, salts):
    quotes = spark.createDataFrame([(7 if k % 3 else k, k) for k in range(300)] + [(None, -1), (7, 1), (7, 1)], "bond bigint, n bigint")
    lookup = spark.createDataFrame([(k, f"XS{k}") for k in range(0, 300, 2)] + [(7, "XS7"), (7, "again"), (None, "none")], "id bigint, isin string")
    left = bucketed.write_bucketed(quotes, f"{tmp_dir}/q{salts}", "bond", 4, salts)
    right = bucketed.write_bucketed_lookup(lookup, f"{tmp_dir}/l{salts}", "id", 4, salts)
    return quotes, lookup, left, right


@pytest.mark.parametrize("salts", [1, 3])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_bucketed_join_equals_a_plain_one_without_an_exchange(spark, tmp_dir, salts, how):
    quotes, lookup, left, right = _sides(spark, tmp_dir, salts)
    joined = bucketed.join_bucketed(spark, left, right, how)
    want = quotes.join(lookup, quotes["bond"] == lookup["id"], how)
    assert joined.columns == want.columns
    assert joined.exceptAll(want).isEmpty() and want.exceptAll(joined).isEmpty()
    plan = _final_plan(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Broadcast" not in plan


def test_a_hot_bond_is_spread_over_buckets(spark, tmp_dir):
    _, _, left, _ = _sides(spark, tmp_dir, 3)
    files = left.read(spark).where("bond = 7").select(F.input_file_name()).distinct().count()
    assert files > 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_sides_of_other_buckets_are_refused(spark, tmp_dir):
    _, lookup, left, _ = _sides(spark, tmp_dir, 1)
    with pytest.raises(ValueError):
        bucketed.join_bucketed(spark, left, bucketed.write_bucketed_lookup(lookup, f"{tmp_dir}/other", "id", 8))


def _feed(spark):
    rows = [("1", "5", "2019-10-01", "1.0", "2.0"), ("x", "5", "2019-10-01", "1.0", "2.0"), ("x", "", "2019-10-01", "n/a", "2.0"),
            (None, "5", "2019-10-01", "1.0", "2.0"), ("2", "327", "2019-10-01", "bad", "2.0"), ("3", "5", "2019-10-01", "1.0", "bad")]
    return spark.createDataFrame(rows, RAW_EXCHANGE)


def test_reject_counts_equal_the_quarantine(spark, tmp_dir):
    seen = Observation("feed")
    good = clean.clean_exchange_quotes(_feed(spark), observation=seen)
    writers.write_parquet(good, f"{tmp_dir}/good")
    assert spark.read.parquet(f"{tmp_dir}/good").count() == 1
    counts = rejects(seen)
    _, bad = split_quarantine(clean.clean_exchange_quotes(_feed(spark), mode="quarantine"))
    fields = [f for r in bad.collect() for f in r["_rejected_fields"]]
    assert (counts["rows"], counts["rejected"]) == (4, bad.count())
    assert {c: counts[f"bad_{c}"] for c in set(fields)} == {c: fields.count(c) for c in set(fields)}
    assert {"bad_bond": 2, "bad_tg": 1, "bad_bid": 1, "bad_ask": 1}.items() <= counts.items()


def test_observation_adds_no_scan(spark):
    plan = clean.clean_exchange_quotes(_feed(spark), observation=Observation("plan"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CollectMetrics") == 1 and plan.count("Scan") == 1


def test_chained_windows_hold_two_states_and_drop_late_minutes(spark, tmp_dir):
    from liqspark.functions.jsonq import parse_quote_json
    from liqspark.operators.windows import sliding_window_agg
    from liqspark.streaming.quotes import chained_quotes, file_source
    from liqspark.streaming.runner import run_available_now, state_rows
    from pyspark.sql.types import StringType, StructField, StructType

    def value(bond, at, money):
        return '{"bond": "%s", "tg": "1", "bid": "1", "ask": "2", "date": "2019-10-01", "update_ts": "2019-10-01T%s", "volume_money": "%s"}' % (bond, at, money)

    first = [value(1, "10:00:10", 1), value(1, "10:00:50", 2), value(1, "10:07:00", 4), value(2, "10:20:00", 8), value(1, "13:30:00", 0)]
    later = [value(1, "10:03:00", 99), value(2, "13:31:00", 16), value(1, "19:00:00", 0)]  # the first one is late
    folder, out = f"{tmp_dir}/landing", f"{tmp_dir}/out"
    schema = StructType([StructField("value", StringType())])
    for part in (first, later):
        spark.createDataFrame([(v,) for v in part], schema).write.mode("append").text(folder)
        run_available_now(chained_quotes(file_source(spark, folder, schema, fmt="text")), out, f"{tmp_dir}/ckpt", state_partitions=2)
    on_time = [v for v in first + later if "99" not in v]
    want = sliding_window_agg(parse_quote_json(spark.createDataFrame([(v,) for v in on_time], schema))).where("window_end <= '2019-10-01 17:00:00'")
    got = spark.read.parquet(out).select(*want.columns)
    assert got.count() > 60 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert [state_rows(spark, f"{tmp_dir}/ckpt", k).count() for k in (0, 1)] == [0, 1]  # no window, one open minute


def test_batch_job_counts_and_keeps_its_rejects(spark, tmp_dir):
    from liqspark.plans import batch_job
    from liqspark.sources.paths import DatedPaths
    paths = DatedPaths("20191005", f"{tmp_dir}/in", f"{tmp_dir}/out")
    writers.write_csv(_feed(spark), paths.exchange_quotes)
    bonds = [("1", "XS1", "2019-01-01", "2030-01-01", "5"), ("bad", "XS2", "2019-01-01", "2030-01-01", "5")]
    writers.write_csv(spark.createDataFrame(bonds, "id string, isin_code string, date_of_end_placing string, maturity_date string, usd_volume string"), paths.bond_list)
    otc = [("1", "9", "2019-10-01", "1", "5"), ("1", "9", "2019-10-01", "2", "6"), ("bad", "9", "2019-10-01", "2", "6")]
    writers.write_csv(spark.createDataFrame(otc, "bond string, org string, date string, quote_type string, price string"), paths.otc_quotes)
    rejected = {}
    out = batch_job.run(spark, paths, otc_pairs=True, metrics_table=f"{tmp_dir}/days", quarantine=f"{tmp_dir}/bad", rejected=rejected)
    assert [r.id for r in out.collect()] == [1]
    assert {k: (v["rejected"], v["rows"]) for k, v in rejected.items()} == {
        "exchange": (3, 4), "bonds": (1, 2), "otc_bids": (0, 1), "otc_asks": (1, 2)}
    kept = {f: spark.read.parquet(f"{tmp_dir}/bad/{f}_20191005").count() for f in rejected}
    assert kept == {"exchange": 3, "bonds": 1, "otc_bids": 0, "otc_asks": 1}
    assert writers.read_newest_metrics(spark, f"{tmp_dir}/days").select("id", "anchor_date").collect() == [(1, "20191005")]
