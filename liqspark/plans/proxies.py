"""Views of the driver's test tables in the shapes of the quote inputs.

The quote feeds themselves are not part of the test data, so each input is a
fixed, documented mapping of a test table (see FIXTURES.md §3). Every mapping
is a projection, so the scans prune columns and the work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed mapping values (FIXTURES.md §3).
# Trading grounds excluded for the proxies (supplier keys standing in for 327 / 381).
PROXY_EXCLUDED_GROUNDS = (27, 81)
# OTC quote side from the return flag: A -> bid (1), R -> ask (2), N -> other (3).
RETURNFLAG_QUOTE_TYPE = {"A": 1, "R": 2, "N": 3}
# Trading ground number of each event type, alphabetical order.
EVENT_TYPE_GROUND = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}
# Listed bond ids and quoted bonds overlap in part: ids are twice the part key,
# intraday bonds twenty times the user.
LISTED_ID_FACTOR, EVENT_BOND_FACTOR = 2, 20
BAD_ID_EVERY = 14
# Text feeds: what the quote lines of these numbers hold instead of a value.
BAD_PRICE_LINE, NO_DATE_LINE, BAD_KEY_LINE = 7, 6, 5
# Bond list dates: placing ends 2010-01-01 + p_size months; maturity 2015-01-01 + p_size years.
PLACING_BASE = "2010-01-01"
MATURITY_BASE = "2015-01-01"
# Snapshot page size (the poll's page limit).
SNAPSHOT_PAGE = 1000

ISO_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from ..sources.readers import read_parquet_table
    return read_parquet_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _year_start(ts: Column) -> Column:
    # date_trunc returns TIMESTAMP; keep the wall-clock type of the input.
    return F.date_trunc("YEAR", ts).cast("timestamp_ntz")


def exchange_quotes(spark: SparkSession, sf_dir: str, coarse: bool = True, extra=()) -> DataFrame:
    """lineitem -> (bond, tg, date, bid, ask). ``coarse``: date = start of the ship year."""
    li = table(spark, sf_dir, "lineitem")
    date = _year_start(F.col("l_shipdate")) if coarse else F.col("l_shipdate")
    return li.select(
        F.col("l_partkey").alias("bond"),
        F.col("l_suppkey").alias("tg"),
        date.alias("date"),
        (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("bid"),
        (F.col("l_extendedprice") * (F.lit(1) + F.col("l_tax"))).alias("ask"),
        *extra,
    )


def otc_quotes(spark: SparkSession, sf_dir: str, extra=()) -> DataFrame:
    """lineitem -> one OTC quote side per row (bond, org, date, quote_type, price)."""
    li = table(spark, sf_dir, "lineitem")
    qtype = F.create_map(*[x for k, v in RETURNFLAG_QUOTE_TYPE.items() for x in (F.lit(k), F.lit(v))])
    return li.select(
        F.col("l_partkey").alias("bond"),
        F.col("l_suppkey").alias("org"),
        _year_start(F.col("l_shipdate")).alias("date"),
        qtype[F.col("l_returnflag")].alias("quote_type"),
        F.col("l_extendedprice").alias("price"),
        *extra,
    )


def exchange_quotes_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exchange feed as the CSV reader delivers it: every column a string,
    with unreadable prices and keys and missing dates on some lines."""
    quotes = exchange_quotes(spark, sf_dir, extra=["l_linenumber"])
    line = F.col("l_linenumber")
    text = {c: F.col(c).cast("string") for c in ("bond", "tg", "date", "bid", "ask")}
    text["bid"] = F.when(line == BAD_PRICE_LINE, "n/a").otherwise(text["bid"])
    text["date"] = F.when(line != NO_DATE_LINE, text["date"])
    text["tg"] = F.when(line == BAD_KEY_LINE, "").otherwise(text["tg"])
    return quotes.select(*[c.alias(name) for name, c in text.items()])


def otc_quotes_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The OTC feed as text; some keys are unreadable."""
    quotes = otc_quotes(spark, sf_dir, extra=["l_linenumber"])
    bond = F.when(F.col("l_linenumber") == BAD_KEY_LINE, "abc").otherwise(F.col("bond").cast("string"))
    return quotes.select(bond.alias("bond"), *[F.col(c).cast("string").alias(c) for c in ("org", "date", "quote_type", "price")])


def bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> raw bond list (id, isin_code, date_of_end_placing, maturity_date, usd_volume)."""
    part = table(spark, sf_dir, "part")
    return part.select(
        (F.col("p_partkey") * LISTED_ID_FACTOR).alias("id"),
        F.col("p_name").alias("isin_code"),
        F.add_months(F.to_date(F.lit(PLACING_BASE)), F.col("p_size"))
        .cast("timestamp_ntz").alias("date_of_end_placing"),
        F.add_months(F.to_date(F.lit(MATURITY_BASE)), F.col("p_size") * 12)
        .cast("timestamp_ntz").alias("maturity_date"),
        F.col("p_retailprice").alias("usd_volume"),
    )


def bonds_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bond list as text; the ids of some are unreadable."""
    sized = bonds(spark, sf_dir)
    bad = F.col("id") % BAD_ID_EVERY == 0
    return sized.select(F.when(bad, "n/a").otherwise(F.col("id").cast("string")).alias("id"),
                        *[F.col(c).cast("string").alias(c) for c in sized.columns if c != "id"])


def _ground(event_type: Column) -> Column:
    lookup = F.create_map(*[x for k, v in EVENT_TYPE_GROUND.items() for x in (F.lit(k), F.lit(v))])
    return lookup[event_type]


def intraday_events(events: DataFrame, extra=()) -> DataFrame:
    """events -> quote events with every field a string (the topic payload fields).

    Prices go through decimals so their text is exact: bid = value,
    ask = value * 1.01, volume_money = value.
    """
    value = F.col("value").cast("decimal(18,2)")
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        (F.col("user_id") * EVENT_BOND_FACTOR).cast("string").alias("bond"),
        value.cast("string").alias("bid"),
        (value * F.lit(1.01).cast("decimal(3,2)")).cast("string").alias("ask"),
        _ground(F.col("event_type")).cast("string").alias("tg"),
        F.to_date(F.col("ts")).cast("string").alias("date"),
        F.date_format(F.col("ts"), ISO_TS).alias("update_ts"),
        F.lit("0").alias("volume"),
        value.cast("string").alias("volume_money"),
        F.lit("0").alias("overturn"),
        *extra,
    )


def intraday_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> topic records: ``value`` (JSON) and ``timestamp`` (the event time)."""
    from ..functions.jsonq import quote_events_to_json
    ev = intraday_events(table(spark, sf_dir, "events"))
    return quote_events_to_json(ev)


def faulty_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records of which errors are cut short, signups hold a null bid and
    views a trading ground that is no number."""
    text = intraday_events(table(spark, sf_dir, "events"), extra=["event_type"])
    bid = F.when(F.col("event_type") != "signup", F.col("bid"))
    tg = F.when(F.col("event_type") == "view", "main board").otherwise(F.col("tg"))
    fields = [(bid if c == "bid" else tg if c == "tg" else F.col(c)).alias(c) for c in text.columns if c != "event_type"]
    whole = text.select("event_type", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))
    short = F.expr("substr(value, 1, length(value) - 1)")
    return whole.select(F.when(F.col("event_type") == "error", short).otherwise(F.col("value")).alias("value"))


def snapshot_documents(events: DataFrame, page_size: int = SNAPSHOT_PAGE) -> DataFrame:
    """Landed REST snapshots: one JSON document per page of ``page_size`` events.

    Items use the service's field names; ``volume`` and ``overturn`` are left
    out so the parser's defaults are exercised. Pages are bounded by
    construction, so no document grows with the data.
    """
    ev = intraday_events(events)
    ev = ev.withColumn("_page", F.floor(F.col("id").cast("bigint") / page_size))
    item = F.create_map(
        F.lit("id"), F.col("id"),
        F.lit("agreement_number"), F.lit("0"),
        F.lit("buying_quote"), F.col("bid"),
        F.lit("date"), F.col("date"),
        F.lit("emission_id"), F.col("bond"),
        F.lit("selling_quote"), F.col("ask"),
        F.lit("trading_ground_id"), F.col("tg"),
        F.lit("update_time"), F.col("update_ts"),
        F.lit("volume_money"), F.col("volume_money"),
    )
    pages = ev.groupBy("_page").agg(F.count(F.lit(1)).alias("count"),
                                    F.collect_list(item).alias("items"))
    doc = F.struct(
        F.col("count"), F.col("count").alias("total"), F.lit(page_size).alias("limit"),
        (F.col("_page") * page_size).alias("offset"), F.col("items"),
    )
    return pages.select(F.to_json(doc).alias("value"))
