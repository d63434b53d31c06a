"""Per-bond liquidity: two-level median of relative spreads and its global rank.

Plan shape (see ``explain``): scan with pushed null filters -> spread ->
level 1, median per (bond, date) -> level 2, median of the daily medians per
bond (one row per bond and day: small) -> range-partitioned rank -> join with
the bond list -> range sort by id.

Level 1 is where one key can be huge (a bond with a third of all quotes). The
method is the caller's choice and never depends on the cluster:

* ``"percentile_approx"`` (default): the original estimator. Every map task
  folds a group into one bounded summary, so a hot key costs one reducer one
  summary per map task. Exact (lower middle element) up to about 50 quotes a
  group, within 1/accuracy of the rank above.
* ``"exact"``: the lower middle element of any group. Quotes are
  range-partitioned on (bond, date, spread) and numbered globally, and the
  wanted numbers are joined back; a hot group spans many partitions.
* ``"kll"``: mergeable KLL sketches, salted by map task over ``salt_buckets``.
  Randomised: a retried task may give another element of the same rank range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.spread import relative_spread
from .joins import broadcast_if_small
from .ranking import global_row_number

# Fixed value of the original job: percentile_approx accuracy.
MEDIAN_ACCURACY = 100
KLL_K = 400
KLL_SALT_BUCKETS = 4
MEDIAN_METHODS = ("percentile_approx", "exact", "kll")

METRIC_COLUMNS = ["id", "isin", "date_of_end_placing", "maturity_date", "usd_volume",
                  "bid_ask_spread_relative_median", "bid_ask_spread_relative_rank"]


def with_relative_spread(quotes: DataFrame, out_col: str = "ba_spread") -> DataFrame:
    return quotes.withColumn(out_col, relative_spread("bid", "ask"))


def exact_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Lower middle element of ``value`` per group, nulls ignored (an all-null
    group gives null; NaN is the largest value).

    No group is gathered: rows are numbered across range partitions, a group's
    first number and size give the number of its middle element, and that
    (unique) number is joined back.
    """
    known = df.where(F.col(value).isNotNull()).select(*keys, value)
    numbered = global_row_number(known, [*[F.col(k) for k in keys], F.col(value)], out_col="_rn")
    middle = numbered.groupBy(*keys).agg(
        (F.min("_rn") + F.expr("(count(1) + 1) div 2") - 1).alias("_middle"))
    found = middle.join(numbered.select(F.col("_rn").alias("_middle"), F.col(value).alias(out)), "_middle").drop("_middle")
    nothing = df.groupBy(*keys).agg(F.count(value).alias("_n")).where("_n = 0")
    return found.unionByName(nothing.select(*keys, F.lit(None).cast(df.schema[value].dataType).alias(out)))


def median_by_bond_date(spreads: DataFrame, accuracy: int = MEDIAN_ACCURACY,
                        method: str = "percentile_approx", salt_buckets: int = KLL_SALT_BUCKETS,
                        kll_k: int = KLL_K) -> DataFrame:
    """Level 1: median spread across trading grounds per bond and day.

    Nulls are ignored; the result is an actual element (the lower middle on an
    even count); an all-null group gives null.
    """
    if method not in MEDIAN_METHODS:
        raise ValueError(f"method must be one of {MEDIAN_METHODS}")
    if method == "percentile_approx":
        return spreads.groupBy("bond", "date").agg(
            F.percentile_approx("ba_spread", 0.5, accuracy).alias("median_of_tgs"))
    if method == "exact":
        return exact_median(spreads, ["bond", "date"], "ba_spread", "median_of_tgs")
    salt = F.pmod(F.spark_partition_id(), F.lit(salt_buckets)).alias("_salt")
    salted = spreads.groupBy("bond", "date", salt).agg(
        F.kll_sketch_agg_double("ba_spread", kll_k).alias("_sk"))
    merged = salted.groupBy("bond", "date").agg(
        F.kll_merge_agg_double("_sk", kll_k).alias("_sk"))
    n = F.kll_sketch_get_n_double("_sk")
    return merged.select(
        "bond", "date",
        F.when(n > 0, F.kll_sketch_get_quantile_double("_sk", F.lit(0.5))).alias("median_of_tgs"))


def median_by_bond(daily: DataFrame, accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """Level 2: median of the daily medians per bond."""
    return daily.groupBy("bond").agg(
        F.percentile_approx("median_of_tgs", 0.5, accuracy).alias("bid_ask_spread_relative_median"))


def median_by_bond_sql(spark: SparkSession, spreads: DataFrame,
                       accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """Both median levels as SQL over a DataFrame argument (no global view)."""
    daily = spark.sql(
        "SELECT bond, `date`, percentile_approx(ba_spread, 0.5, {acc}) AS median_of_tgs "
        "FROM {spreads} GROUP BY bond, `date`", spreads=spreads, acc=int(accuracy))
    return spark.sql(
        "SELECT bond, percentile_approx(median_of_tgs, 0.5, {acc}) "
        "AS bid_ask_spread_relative_median FROM {daily} GROUP BY bond",
        daily=daily, acc=int(accuracy))


def rank_by_median(medians: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """rank = position / number of bonds, widest spread first.

    Order: median descending, nulls last (a bond without a spread ranks last
    but still counts), ties by bond ascending. Distributed: no single-task
    window, no driver-side count.
    """
    order = [F.col("bid_ask_spread_relative_median").desc_nulls_last(), F.col("bond").asc()]
    ranked = global_row_number(medians, order, out_col="_current", total_col="_total",
                               num_partitions=num_partitions)
    return ranked.select(
        "bond", "bid_ask_spread_relative_median",
        (F.col("_current") / F.col("_total")).alias("bid_ask_spread_relative_rank"))


def daily_medians(exchange: DataFrame, accuracy: int = MEDIAN_ACCURACY,
                  method: str = "percentile_approx", salt_buckets: int = KLL_SALT_BUCKETS) -> DataFrame:
    """Cleaned exchange quotes -> median relative spread per bond and day."""
    return median_by_bond_date(with_relative_spread(exchange), accuracy, method, salt_buckets)


def spread_medians(exchange: DataFrame, accuracy: int = MEDIAN_ACCURACY,
                   method: str = "percentile_approx", salt_buckets: int = KLL_SALT_BUCKETS) -> DataFrame:
    """Cleaned exchange quotes -> per-bond median relative spread."""
    return median_by_bond(daily_medians(exchange, accuracy, method, salt_buckets), accuracy)


def liquidity_metrics(exchange: DataFrame, bonds: DataFrame, accuracy: int = MEDIAN_ACCURACY,
                      num_partitions: int | None = None, sort: bool = True,
                      method: str = "percentile_approx", salt_buckets: int = KLL_SALT_BUCKETS) -> DataFrame:
    """Bond list joined with median spread and rank, ordered by id.

    The rank is taken over all bonds with quotes *before* the inner join, so
    ranks of listed bonds may have gaps; a duplicated id in the list fans out.
    The bond list is broadcast only when its counted size bound fits the
    broadcast threshold; otherwise the join is a sort-merge join.
    """
    daily = daily_medians(exchange, accuracy, method, salt_buckets)
    return metrics_of_daily(daily, bonds, accuracy, num_partitions, sort)


def metrics_of_daily(daily: DataFrame, bonds: DataFrame, accuracy: int = MEDIAN_ACCURACY,
                     num_partitions: int | None = None, sort: bool = True) -> DataFrame:
    """``liquidity_metrics`` from the daily medians on. A day's median does not depend on other days, so the
    metrics of several spans of days can share one table of them (``daily.where(date <= ...)``)."""
    ranks = rank_by_median(median_by_bond(daily, accuracy), num_partitions)
    bonds, _ = broadcast_if_small(bonds)
    joined = bonds.join(ranks, bonds["id"] == ranks["bond"], "inner").select(*METRIC_COLUMNS)
    return joined.orderBy(F.col("id").asc()) if sort else joined
