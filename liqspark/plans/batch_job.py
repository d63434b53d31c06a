"""Daily batch job: three CSV inputs -> bond liquidity metrics -> sinks.

    python -m liqspark.plans.batch_job --input-root IN --output-root OUT \
        [--anchor yyyyMMdd] [--jdbc-url URL --jdbc-table T --jdbc-user U \
         --jdbc-password-env VAR] [--otc-pairs] [--show 40]

The metrics are written to Parquet first; the CSV copy, the JDBC table and
the printed head are then read from that Parquet copy. A written table cuts
the lineage (an executor lost later does not send the job back to the raw
quotes) and replaces the original's repeated recomputation from CSV.
"""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, liquidity
from ..schemas import rejects, split_quarantine
from ..sinks import writers
from ..sources import readers
from ..sources.paths import DatedPaths


@dataclass
class JdbcTarget:
    url: str
    table: str
    properties: dict


def anchor_for_now(spark: SparkSession) -> str:
    """Anchor date of the current instant (one row computed by Spark)."""
    from ..functions.timeutil import anchor_date
    tz = spark.conf.get("spark.sql.session.timeZone")
    return spark.range(1).select(anchor_date(F.current_timestamp(), source_tz=tz).alias("a")).first()["a"]


def compute_metrics(spark: SparkSession, paths: DatedPaths,
                    excluded_grounds=clean.EXCLUDED_GROUNDS, mode: str = "drop",
                    accuracy: int = liquidity.MEDIAN_ACCURACY,
                    observed: dict[str, Observation] | None = None) -> DataFrame:
    """``observed`` counts the rejects of the feeds that it names (``exchange``, ``bonds``)."""
    observed = observed or {}
    exchange = clean.clean_exchange_quotes(readers.read_exchange_quotes(spark, paths.exchange_quotes),
                                           excluded_grounds, mode, observed.get("exchange"))
    bonds = clean.clean_bonds(readers.read_bond_list(spark, paths.bond_list), mode, observed.get("bonds"))
    return liquidity.liquidity_metrics(exchange, bonds, accuracy)


def run(spark: SparkSession, paths: DatedPaths, jdbc: JdbcTarget | None = None,
        single_file: bool = False, otc_pairs: bool = False, show: int = 0,
        mode: str = "drop", excluded_grounds=clean.EXCLUDED_GROUNDS,
        metrics_table: str | None = None, quarantine: str | None = None,
        rejected: dict | None = None) -> DataFrame:
    """Compute and write the metrics; returns the Parquet copy as a DataFrame.

    ``metrics_table`` also receives the day as a partition of one table. ``rejected`` (a dict) is filled
    with each feed's reject counts, counted while the feed is read; ``quarantine`` is a folder that
    receives the rejected rows of each feed with the fields that they break.
    """
    observed = {} if mode == "assert" else {"exchange": Observation("exchange"), "bonds": Observation("bonds")}
    metrics = compute_metrics(spark, paths, excluded_grounds, mode=mode, observed=observed)
    writers.write_parquet(metrics, paths.metrics_parquet, single_file=single_file)
    stored = writers.read_metrics_parquet(spark, paths.metrics_parquet)
    if metrics_table:
        writers.write_metrics_day(stored, metrics_table, paths.anchor)
    writers.write_csv(stored, paths.metrics_csv, single_file=single_file)
    if jdbc is not None:
        writers.write_jdbc(stored, jdbc.url, jdbc.table, jdbc.properties)
    if otc_pairs:
        sides = None if mode == "assert" else (Observation("otc_bids"), Observation("otc_asks"))
        pairs = clean.pair_otc_quotes(readers.read_otc_quotes(spark, paths.otc_quotes), mode, sides)
        writers.write_parquet(pairs, f"{paths.metrics_parquet}_otc_pairs")
        observed |= dict(zip(("otc_bids", "otc_asks"), sides or ()))
    if rejected is not None:
        rejected.update({feed: rejects(seen) for feed, seen in observed.items()})
    if quarantine:
        _write_quarantine(spark, paths, quarantine, excluded_grounds, otc_pairs)
    if show:
        stored.orderBy("id").show(show)
        stored.printSchema()
    return stored


def _write_quarantine(spark: SparkSession, paths: DatedPaths, folder: str, excluded_grounds, otc_pairs: bool) -> None:
    """Rejected rows only, a folder for each feed and day: one more scan, no shuffle."""
    tagged = {"exchange": clean.clean_exchange_quotes(readers.read_exchange_quotes(spark, paths.exchange_quotes), excluded_grounds, "quarantine"),
              "bonds": clean.clean_bonds(readers.read_bond_list(spark, paths.bond_list), "quarantine")}
    if otc_pairs:
        raw = readers.read_otc_quotes(spark, paths.otc_quotes)
        tagged |= {f"otc_{side}s": clean.otc_side(raw, kind, side, "quarantine") for side, kind in (("bid", clean.OTC_BID), ("ask", clean.OTC_ASK))}
    for feed, rows in tagged.items():
        writers.write_parquet(split_quarantine(rows)[1], f"{folder.rstrip('/')}/{feed}_{paths.anchor}")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--input-root", required=True)
    ap.add_argument("--output-root", required=True)
    ap.add_argument("--anchor", help="yyyyMMdd; default: from the current time")
    ap.add_argument("--mode", default="drop", choices=["drop", "assert"])
    ap.add_argument("--single-file", action="store_true")
    ap.add_argument("--otc-pairs", action="store_true")
    ap.add_argument("--metrics-table", help="folder of a table that keeps every day as a partition")
    ap.add_argument("--quarantine", help="folder for rejected rows")
    ap.add_argument("--show", type=int, default=40)
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-table", default="bonds_liquidity_metrics")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
    ap.add_argument("--jdbc-driver")
    args = ap.parse_args(argv)

    from ..session import build_session
    spark = build_session(app_name="liqspark-batch")
    anchor = args.anchor or anchor_for_now(spark)
    paths = DatedPaths(anchor, args.input_root, args.output_root)
    jdbc = None
    if args.jdbc_url:
        props = {"user": args.jdbc_user or ""}
        if args.jdbc_password_env:
            props["password"] = os.environ.get(args.jdbc_password_env, "")
        if args.jdbc_driver:
            props["driver"] = args.jdbc_driver
        jdbc = JdbcTarget(args.jdbc_url, args.jdbc_table, props)
    rejected: dict = {}
    run(spark, paths, jdbc, args.single_file, args.otc_pairs, args.show, args.mode,
        metrics_table=args.metrics_table, quarantine=args.quarantine, rejected=rejected)
    for feed, counts in rejected.items():
        print(f"{feed}: {counts['rejected']} of {counts['rows']} rows rejected")
    for name, path in paths.all().items():
        print(f"{name}: {path}")
    spark.stop()


if __name__ == "__main__":
    main()
