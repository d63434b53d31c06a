"""Properties: rank is a permutation, distributed rank = brute force, window
strategies agree, SQL = DSL, n*m fan-out."""

import datetime as dt
import random

import pytest

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from liqspark.operators import clean, liquidity
from liqspark.operators.ranking import global_row_number
from liqspark.operators.windows import latest_quote, sliding_window_agg

SF = "/root/testdata/sf0.001"


def _brute_rank(df):
    # Single-partition window: fine for a small fixture, never used in the library.
    w = Window.orderBy(F.col("bid_ask_spread_relative_median").desc_nulls_last(), F.col("bond"))
    return df.select("bond", (F.row_number().over(w) / F.count("*").over(Window.partitionBy()))
                     .alias("rank"))


@settings(max_examples=6, deadline=None)
@given(values=st.lists(st.one_of(st.none(), st.sampled_from([0.01, 0.02, 0.05, 0.1, -0.02])),
                       min_size=1, max_size=60),
       parts=st.integers(min_value=1, max_value=9))
def test_distributed_rank_equals_single_window(spark, values, parts):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)],
                               "bond long, bid_ask_spread_relative_median double")
    got = {r.bond: r.bid_ask_spread_relative_rank
           for r in liquidity.rank_by_median(df, num_partitions=parts).collect()}
    expect = {r.bond: r.rank for r in _brute_rank(df).collect()}
    assert got == expect
    n = len(values)
    assert sorted(round(v * n) for v in got.values()) == list(range(1, n + 1))


def test_global_row_number_is_permutation_at_scale_of_fixture(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    out = global_row_number(ev, [F.col("value").desc(), F.col("event_id")], "rn",
                            total_col="n", num_partitions=7)
    rows = out.select("rn", "n").collect()
    assert sorted(r.rn for r in rows) == list(range(1, len(rows) + 1))
    assert {r.n for r in rows} == {len(rows)}


def test_rank_on_real_medians_matches_brute_force(spark):
    from liqspark.plans import catalog
    med = liquidity.spread_medians(catalog._exchange(spark, SF))
    got = liquidity.rank_by_median(med, num_partitions=5).select(
        "bond", F.col("bid_ask_spread_relative_rank").alias("rank"))
    assert got.exceptAll(_brute_rank(med)).count() == 0


def test_sql_and_dsl_medians_agree(spark):
    from liqspark.plans import catalog
    spreads = liquidity.with_relative_spread(catalog._exchange(spark, SF))
    a = liquidity.median_by_bond(liquidity.median_by_bond_date(spreads))
    b = liquidity.median_by_bond_sql(spark, spreads)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_preaggregated_windows_equal_native(spark):
    from liqspark.plans import catalog
    q = catalog._typed_quotes(spark, SF)
    a = sliding_window_agg(q, method="buckets").withColumn("volume_money", F.round("volume_money", 6))
    b = sliding_window_agg(q, method="plain").withColumn("volume_money", F.round("volume_money", 6))
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def test_preaggregation_with_uneven_slide(spark):
    # window 10 min, slide 4 min: buckets of gcd = 2 minutes.
    rng = random.Random(7)
    t0 = dt.datetime(2019, 10, 1, 10, 0)
    rows = [(rng.randint(1, 3), 1, dt.date(2019, 10, 1), float(rng.randint(1, 9)), 1.0, 1.0,
             t0 + dt.timedelta(seconds=rng.randint(0, 3600))) for _ in range(200)]
    df = spark.createDataFrame(rows, "bond long, tg long, date date, volume_money double, "
                                     "bid double, ask double, update_ts timestamp")
    a = sliding_window_agg(df, "10 minutes", "4 minutes", method="buckets")
    b = sliding_window_agg(df, "10 minutes", "4 minutes", method="plain")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_otc_fan_out_is_n_times_m(spark):
    d = dt.datetime(2019, 10, 1)
    rows = [(1, 1, d, 1, 10.0 + i) for i in range(4)] + [(1, 1, d, 2, 20.0 + i) for i in range(3)]
    raw = spark.createDataFrame(rows, "bond long, org long, date timestamp_ntz, quote_type int, price double")
    assert clean.pair_otc_quotes(raw).count() == 12


def test_latest_quote_matches_window_definition(spark):
    from liqspark.plans import catalog
    q = catalog._typed_quotes(spark, SF)
    w = Window.partitionBy("bond", "tg").orderBy(F.col("update_ts").desc_nulls_last(),
                                                 *[F.col(c).desc() for c in
                                                   ("volume_money", "bid", "ask", "overturn", "date")])
    expect = q.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    got = latest_quote(q)
    assert got.select(*expect.columns).exceptAll(expect).count() == 0
    assert got.count() == expect.count()


def test_rank_correct_when_aqe_coalesces_range_partitions(spark):
    from liqspark.plans import catalog
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        med = liquidity.spread_medians(catalog._exchange(spark, SF))
        got = liquidity.rank_by_median(med).select(
            "bond", F.col("bid_ask_spread_relative_rank").alias("rank"))
        assert got.exceptAll(_brute_rank(med)).count() == 0
        assert got.count() == med.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_kll_level1_median_on_a_hot_group_is_within_one_percent_rank(spark):
    # One (bond, date) holding most rows, spread over many map tasks.
    n = 40_000
    df = (spark.range(n, numPartitions=24)
          .select(F.lit(1).cast("long").alias("bond"),
                  F.lit("2019-10-01").cast("timestamp_ntz").alias("date"),
                  (F.sin(F.col("id")) * 1000).alias("ba_spread"))
          .unionByName(spark.createDataFrame([(2, None, 0.5)], "bond long, date timestamp_ntz, ba_spread double")
                       .withColumn("date", F.lit("2019-10-01").cast("timestamp_ntz"))))
    got = {r.bond: r.median_of_tgs
           for r in liquidity.median_by_bond_date(df, method="kll", salt_buckets=4).collect()}
    below = df.where((F.col("bond") == 1) & (F.col("ba_spread") <= got[1])).count()
    assert abs(below / n - 0.5) < 0.01
    assert got[2] == 0.5
    pa = {r.bond: r.median_of_tgs
          for r in liquidity.median_by_bond_date(df, method="percentile_approx").collect()}
    below_pa = df.where((F.col("bond") == 1) & (F.col("ba_spread") <= pa[1])).count()
    assert abs(below_pa / n - 0.5) < 0.01


def test_salted_and_single_stage_kll_agree_on_proxy_quotes(spark):
    from liqspark.plans import catalog
    spreads = liquidity.with_relative_spread(catalog._exchange(spark, SF))
    a = liquidity.median_by_bond_date(spreads, method="kll", salt_buckets=5)
    b = liquidity.median_by_bond_date(spreads, method="kll", salt_buckets=1)
    c = liquidity.median_by_bond_date(spreads, method="percentile_approx")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.exceptAll(c).count() == 0


@pytest.mark.parametrize("window,slide", [("30 minutes", "1 minute"), ("10 minutes", "4 minutes"), ("5 minutes", "5 minutes")])
def test_framed_windows_equal_native(spark, window, slide):
    """Dense and sparse keys, null prices, null times, times before 1970 and over midnight."""
    rng = random.Random(7)
    base = dt.datetime(1969, 12, 31, 23, 40)
    rows = []
    for _ in range(400):
        ts = None if rng.random() < .03 else base + dt.timedelta(seconds=rng.randrange(0, rng.choice([600, 40_000])))
        price = None if rng.random() < .2 else float(rng.randrange(100))
        rows.append((rng.randrange(3), rng.choice([1, 2, None]), ts.date() if ts else None, price, price, price, ts))
    q = spark.createDataFrame(rows, "bond long, tg long, date date, volume_money double, bid double, ask double, update_ts timestamp").repartition(3)
    a, b = sliding_window_agg(q, window, slide, method="frames"), sliding_window_agg(q, window, slide, method="plain")
    assert a.schema.simpleString() == b.schema.simpleString() and b.count() > 100
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    with pytest.raises(ValueError):
        sliding_window_agg(q, method="other")
