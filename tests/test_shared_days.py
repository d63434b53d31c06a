"""The daily copies of the metrics share one table of daily medians."""

from datetime import datetime

from liqspark.operators import liquidity
from liqspark.plans import catalog


def _tables(spark, folder):
    lines = [(1, p, s, n, 1.0, 100.0 + 7 * n + p, 0.01 * s, 0.02 * n, datetime(y, 5, 1 + n))
             for p in (2, 4, 6) for s in (1, 2, 27) for n in (1, 2) for y in (1995, 1996, 1997, 1998) if (p, y) != (6, 1998)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")
    parts = [(1, "a", 3, 10.0), (2, "b", 4, 11.0), (3, "c", 5, 12.0), (4, "d", 6, None)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_size int, p_retailprice double").write.parquet(f"{folder}/part.parquet")


def test_latest_anchor_aggregates_the_quotes_once(spark, tmp_dir, monkeypatch):
    _tables(spark, tmp_dir)
    calls, real = [], liquidity.median_by_bond_date
    monkeypatch.setattr(liquidity, "median_by_bond_date", lambda *a, **k: calls.append(1) or real(*a, **k))
    got = catalog.REGISTRY["metrics_latest_anchor"].fn(spark, tmp_dir)
    assert len(calls) == 1  # five before: once a written copy
    want = liquidity.liquidity_metrics(catalog._exchange(spark, tmp_dir), catalog._bonds(spark, tmp_dir))
    assert [r[0] for r in got.select("anchor_date").distinct().collect()] == ["19980101"]
    assert sorted(map(tuple, got.drop("anchor_date").collect())) == sorted(map(tuple, want.collect())) and got.count() == 3


def test_metrics_of_daily_medians_up_to_a_day(spark, tmp_dir):
    _tables(spark, tmp_dir)
    quotes, bonds, day = catalog._exchange(spark, tmp_dir), catalog._bonds(spark, tmp_dir), "date <= timestamp_ntz'1996-01-01'"
    got = liquidity.metrics_of_daily(liquidity.daily_medians(quotes).where(day), bonds)
    assert got.collect() == liquidity.liquidity_metrics(quotes.where(day), bonds).collect()
