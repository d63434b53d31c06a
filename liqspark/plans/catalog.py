"""Named queries over the test tables, each with its DuckDB oracle SQL.

Every query reads whole tables (through the proxies of ``proxies.py``) and
returns a DataFrame; columns are aliased identically in the oracle. Streaming
queries run with ``availableNow`` into a fresh folder under the shared
checkpoint root and return the sink read back; their oracle is the batch SQL
restricted to the windows the watermark has closed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session as S
from ..operators import clean, liquidity
from . import proxies as P


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            S.prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, run, oracle)
        return run
    return deco


# ---------------------------------------------------------------------------
# Shared building blocks (Spark side)

def _exchange(spark, sf_dir):
    return clean.clean_exchange_quotes(P.exchange_quotes(spark, sf_dir),
                                       excluded_grounds=P.PROXY_EXCLUDED_GROUNDS)


def _bonds(spark, sf_dir):
    return clean.clean_bonds(P.bonds(spark, sf_dir))


def _metrics(spark, sf_dir, num_partitions=None, sort=True):
    return liquidity.liquidity_metrics(_exchange(spark, sf_dir), _bonds(spark, sf_dir),
                                       num_partitions=num_partitions, sort=sort)


# ---------------------------------------------------------------------------
# Shared building blocks (oracle side, DuckDB SQL)

SQL_EXCHANGE = """
ex AS (
  SELECT l_partkey AS bond, l_suppkey AS tg, date_trunc('year', l_shipdate) AS "date",
         l_extendedprice * (1 - l_discount) AS bid, l_extendedprice * (1 + l_tax) AS ask
  FROM lineitem
  WHERE l_suppkey NOT IN (27, 81)
)"""

SQL_SPREAD = SQL_EXCHANGE + """,
sp AS (
  SELECT bond, tg, "date", bid, ask,
         CASE WHEN (ask + bid) / 2 = 0 THEN NULL ELSE (ask - bid) / ((ask + bid) / 2) END AS ba_spread
  FROM ex
)"""

SQL_DAILY = SQL_SPREAD + """,
daily AS (
  SELECT bond, "date", quantile_disc(ba_spread, 0.5) AS median_of_tgs
  FROM sp GROUP BY bond, "date"
)"""

SQL_MEDIAN = SQL_DAILY + """,
med AS (
  SELECT bond, quantile_disc(median_of_tgs, 0.5) AS bid_ask_spread_relative_median
  FROM daily GROUP BY bond
)"""

SQL_RANK = SQL_MEDIAN + """,
rk AS (
  SELECT bond, bid_ask_spread_relative_median,
         CAST(row_number() OVER (ORDER BY bid_ask_spread_relative_median DESC NULLS LAST, bond) AS DOUBLE)
           / CAST(count(*) OVER () AS DOUBLE) AS bid_ask_spread_relative_rank
  FROM med
)"""

SQL_BONDS = """
bl AS (
  SELECT p_partkey * 2 AS id, p_name AS isin,
         TIMESTAMP '2010-01-01' + to_months(p_size) AS date_of_end_placing,
         TIMESTAMP '2015-01-01' + to_years(p_size) AS maturity_date,
         p_retailprice AS usd_volume
  FROM part
)"""

SQL_METRICS = SQL_RANK + "," + SQL_BONDS + """,
metrics AS (
  SELECT bl.id, bl.isin, bl.date_of_end_placing, bl.maturity_date, bl.usd_volume,
         rk.bid_ask_spread_relative_median, rk.bid_ask_spread_relative_rank
  FROM bl JOIN rk ON rk.bond = bl.id
)"""


# ---------------------------------------------------------------------------
# Batch liquidity metrics

@register("liquidity_metrics", "WITH " + SQL_METRICS + "\nSELECT * FROM metrics ORDER BY id")
def q_liquidity_metrics(spark, sf_dir):
    """Headline batch query: bond list x median spread x rank, ordered by id."""
    return _metrics(spark, sf_dir)


@register("exchange_clean", "WITH " + SQL_EXCHANGE + "\nSELECT * FROM ex")
def q_exchange_clean(spark, sf_dir):
    return _exchange(spark, sf_dir)


@register("bonds_clean", "WITH " + SQL_BONDS + "\nSELECT * FROM bl")
def q_bonds_clean(spark, sf_dir):
    return _bonds(spark, sf_dir)


@register("relative_spread", "WITH " + SQL_SPREAD + "\nSELECT * FROM sp")
def q_relative_spread(spark, sf_dir):
    return liquidity.with_relative_spread(_exchange(spark, sf_dir))


@register("median_by_bond_date", "WITH " + SQL_DAILY + "\nSELECT * FROM daily")
def q_median_by_bond_date(spark, sf_dir):
    return liquidity.median_by_bond_date(liquidity.with_relative_spread(_exchange(spark, sf_dir)))


@register("median_by_bond", "WITH " + SQL_MEDIAN + "\nSELECT * FROM med")
def q_median_by_bond(spark, sf_dir):
    return liquidity.spread_medians(_exchange(spark, sf_dir))


@register("median_by_bond_sql", "WITH " + SQL_MEDIAN + "\nSELECT * FROM med")
def q_median_by_bond_sql(spark, sf_dir):
    """Same medians through ``spark.sql`` over DataFrame arguments."""
    return liquidity.median_by_bond_sql(spark, liquidity.with_relative_spread(_exchange(spark, sf_dir)))


@register("liquidity_rank", "WITH " + SQL_RANK + "\nSELECT * FROM rk")
def q_liquidity_rank(spark, sf_dir):
    return liquidity.rank_by_median(liquidity.spread_medians(_exchange(spark, sf_dir)))


@register("liquidity_rank_distributed", "WITH " + SQL_RANK + "\nSELECT * FROM rk")
def q_liquidity_rank_distributed(spark, sf_dir):
    """The rank over a fixed, larger number of range partitions: same result."""
    n = 4 * spark.sparkContext.defaultParallelism
    return liquidity.rank_by_median(liquidity.spread_medians(_exchange(spark, sf_dir)),
                                    num_partitions=n)


@register("metrics_first_40", "WITH " + SQL_METRICS + "\nSELECT * FROM metrics ORDER BY id LIMIT 40")
def q_metrics_first_40(spark, sf_dir):
    """The printed report: first 40 bonds by id (a top-k, the limit is the feature)."""
    return _metrics(spark, sf_dir).limit(40)


# ---------------------------------------------------------------------------
# OTC pairing, strict schemas, sentinel, anchor date

SQL_OTC = """
otc AS (
  SELECT l_partkey AS bond, l_suppkey AS org, date_trunc('year', l_shipdate) AS "date",
         CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 WHEN 'N' THEN 3 END AS quote_type,
         l_extendedprice AS price
  FROM lineitem
),
otc_bid AS (SELECT bond, org, "date", price AS bid FROM otc
            WHERE quote_type = 1 AND bond IS NOT NULL AND org IS NOT NULL AND "date" IS NOT NULL
              AND price IS NOT NULL AND price > 0),
otc_ask AS (SELECT bond, org, "date", price AS ask FROM otc
            WHERE quote_type = 2 AND bond IS NOT NULL AND org IS NOT NULL AND "date" IS NOT NULL
              AND price IS NOT NULL AND price > 0)"""


@register("otc_pairing", "WITH " + SQL_OTC + """
SELECT b.bond, b.org, b."date", b.bid, a.ask
FROM otc_bid b JOIN otc_ask a ON a.bond = b.bond AND a.org = b.org AND a."date" = b."date"
""")
def q_otc_pairing(spark, sf_dir):
    """Every OTC bid with every ask of the same (bond, org, date)."""
    return clean.pair_otc_quotes(P.otc_quotes(spark, sf_dir))


SQL_EXCHANGE_TEXT = """
ext AS (
  SELECT l_partkey AS bond, l_suppkey AS tg, date_trunc('year', l_shipdate) AS "date",
         l_extendedprice * (1 - l_discount) AS bid, l_extendedprice * (1 + l_tax) AS ask, l_linenumber AS line
  FROM lineitem WHERE l_linenumber <> 6 AND (l_linenumber = 5 OR l_suppkey NOT IN (27, 81))
)"""


@register("strict_schema_drop", "WITH " + SQL_EXCHANGE_TEXT +
          "\nSELECT bond, tg, \"date\", bid, ask FROM ext WHERE line NOT IN (5, 7)")
def q_strict_schema_drop(spark, sf_dir):
    """Text columns -> typed, non-null contract enforced by dropping bad rows."""
    return clean.clean_exchange_quotes(P.exchange_quotes_text(spark, sf_dir),
                                       excluded_grounds=P.PROXY_EXCLUDED_GROUNDS, mode="drop")


def _shown(tagged, columns):
    """Tagged rows with nulls shown as -1 and the broken fields as text."""
    from ..schemas import REJECT_COL
    shown = tagged.withColumns({c: F.coalesce(c, F.lit(-1).cast(t)) for c, t in tagged.dtypes if c in columns})
    return shown.withColumn("rejected_fields", F.array_join(REJECT_COL, ",")).drop(REJECT_COL)


@register("strict_schema_quarantine", "WITH " + SQL_EXCHANGE_TEXT + """
SELECT bond, CASE WHEN line = 5 THEN -1 ELSE tg END AS tg, "date", CASE WHEN line = 7 THEN -1 ELSE bid END AS bid, ask,
       CASE line WHEN 5 THEN 'tg' WHEN 7 THEN 'bid' ELSE '' END AS rejected_fields FROM ext""")
def q_strict_schema_quarantine(spark, sf_dir):
    """Same contract, every row kept and tagged with the fields that broke it."""
    return _shown(clean.clean_exchange_quotes(P.exchange_quotes_text(spark, sf_dir),
                                              excluded_grounds=P.PROXY_EXCLUDED_GROUNDS, mode="quarantine"), ["tg", "bid"])


SQL_OTC_TEXT = """
side AS (
  SELECT CASE WHEN l_linenumber = 5 THEN -1 ELSE l_partkey END AS bond, l_suppkey AS org, date_trunc('year', l_shipdate) AS "date",
         l_extendedprice AS price, l_returnflag AS flag, l_linenumber = 5 AS bad FROM lineitem WHERE l_extendedprice > 0
)"""


@register("otc_strict_quarantine", "WITH " + SQL_OTC_TEXT + """
SELECT b.bond, b.org, b."date", b.price AS bid, a.price AS ask, '' AS rejected_fields
FROM side b JOIN side a ON a.bond = b.bond AND a.org = b.org AND a."date" = b."date"
WHERE b.flag = 'A' AND a.flag = 'R' AND NOT a.bad AND NOT b.bad
UNION ALL SELECT bond, org, "date", CASE flag WHEN 'A' THEN price ELSE -1 END, CASE flag WHEN 'R' THEN price ELSE -1 END, 'bond'
FROM side WHERE bad AND flag IN ('A', 'R')""")
def q_otc_strict_quarantine(spark, sf_dir):
    """OTC pairs of a text feed; quotes with an unreadable key come out unpaired."""
    return _shown(clean.pair_otc_quotes(P.otc_quotes_text(spark, sf_dir), mode="quarantine"), ["bond", "bid", "ask"])


SQL_REJECTS = "WITH " + SQL_EXCHANGE_TEXT + "," + SQL_OTC_TEXT + """,
bond AS (SELECT p_partkey * 2 AS id FROM part)
SELECT 'exchange' AS feed, 'tg' AS field, count(*) FILTER (line = 5) AS rejected, count(*) AS n_rows FROM ext
UNION ALL SELECT 'exchange', 'bid', count(*) FILTER (line = 7), count(*) FROM ext
UNION ALL SELECT 'exchange', '', count(*) FILTER (line IN (5, 7)), count(*) FROM ext
UNION ALL SELECT 'otc_bids', 'bond', count(*) FILTER (bad), count(*) FROM side WHERE flag = 'A'
UNION ALL SELECT 'otc_bids', '', count(*) FILTER (bad), count(*) FROM side WHERE flag = 'A'
UNION ALL SELECT 'otc_asks', 'bond', count(*) FILTER (bad), count(*) FROM side WHERE flag = 'R'
UNION ALL SELECT 'otc_asks', '', count(*) FILTER (bad), count(*) FROM side WHERE flag = 'R'
UNION ALL SELECT 'bonds', 'id', count(*) FILTER (id % 14 = 0), count(*) FROM bond
UNION ALL SELECT 'bonds', '', count(*) FILTER (id % 14 = 0), count(*) FROM bond"""


@register("reject_counts", "SELECT * FROM (" + SQL_REJECTS + ") WHERE rejected > 0 OR field = ''")
def q_reject_counts(spark, sf_dir):
    """Rejected rows of every feed and, of those, the ones that break each field (a feed's total has
    no field): counted while the metrics and the OTC pairs are made and written, without a scan of their own."""
    from pyspark.sql import Observation
    from ..schemas import rejects
    from ..sinks.writers import write_parquet
    seen = {feed: Observation(feed) for feed in ("exchange", "bonds", "otc_bids", "otc_asks")}
    exchange = clean.clean_exchange_quotes(P.exchange_quotes_text(spark, sf_dir), P.PROXY_EXCLUDED_GROUNDS, observation=seen["exchange"])
    bonds = clean.clean_bonds(P.bonds_text(spark, sf_dir), observation=seen["bonds"])
    pairs = clean.pair_otc_quotes(P.otc_quotes_text(spark, sf_dir), observations=(seen["otc_bids"], seen["otc_asks"]))
    for df, name in ((liquidity.liquidity_metrics(exchange, bonds, sort=False), "counted-metrics"), (pairs, "counted-pairs")):
        S.remove_scratch(spark, write_parquet(df, S.scratch_dir(spark, name)))
    rows = []
    for feed, observation in seen.items():
        counts = rejects(observation)
        rows += [(feed, "", counts["rejected"], counts["rows"])]
        rows += [(feed, c.removeprefix("bad_"), n, counts["rows"]) for c, n in counts.items() if c.startswith("bad_") and n]
    return spark.createDataFrame(rows, "feed string, field string, rejected bigint, n_rows bigint")


# ---------------------------------------------------------------------------
# CSV scans: the whole feed written as header CSV, then read as the batch job reads it

def _as_csv(spark, df, name):
    from ..sinks.writers import write_csv
    return write_csv(df, S.scratch_dir(spark, name))


@register("csv_exchange_scan", "WITH " + SQL_EXCHANGE_TEXT +
          "\nSELECT bond, tg, \"date\", bid, ask FROM ext WHERE line NOT IN (5, 7)")
def q_csv_exchange_scan(spark, sf_dir):
    """Exchange quotes from header CSV files, cleaned and typed."""
    from ..sources.readers import read_exchange_quotes
    raw = read_exchange_quotes(spark, _as_csv(spark, P.exchange_quotes_text(spark, sf_dir), "csv-exchange"))
    return clean.clean_exchange_quotes(raw, excluded_grounds=P.PROXY_EXCLUDED_GROUNDS)


@register("csv_otc_scan", "WITH " + SQL_OTC_TEXT + """
SELECT b.bond, b.org, b."date", b.price AS bid, a.price AS ask
FROM side b JOIN side a ON a.bond = b.bond AND a.org = b.org AND a."date" = b."date"
WHERE b.flag = 'A' AND a.flag = 'R' AND NOT a.bad AND NOT b.bad""")
def q_csv_otc_scan(spark, sf_dir):
    """OTC quotes from header CSV files, paired."""
    from ..sources.readers import read_otc_quotes
    return clean.pair_otc_quotes(read_otc_quotes(spark, _as_csv(spark, P.otc_quotes_text(spark, sf_dir), "csv-otc")))


@register("csv_bonds_scan", "WITH " + SQL_BONDS + "\nSELECT * FROM bl")
def q_csv_bonds_scan(spark, sf_dir):
    """The bond list from header CSV files, typed."""
    from ..sources.readers import read_bond_list
    return clean.clean_bonds(read_bond_list(spark, _as_csv(spark, P.bonds(spark, sf_dir), "csv-bonds")))


@register("median_large_groups", """
SELECT l_suppkey AS tg, quantile_disc((l_extendedprice * (1 + l_tax) - l_extendedprice * (1 - l_discount))
         / ((l_extendedprice * (1 + l_tax) + l_extendedprice * (1 - l_discount)) / 2), 0.5) AS median_spread
FROM lineitem GROUP BY l_suppkey""")
def q_median_large_groups(spark, sf_dir):
    """Exact median spread per trading ground: groups of hundreds of quotes."""
    spreads = liquidity.with_relative_spread(P.exchange_quotes(spark, sf_dir))
    return liquidity.exact_median(spreads, ["tg"], "ba_spread", "median_spread")


@register("far_date_sentinel", "WITH " + SQL_BONDS + """
SELECT id, isin,
       CASE WHEN date_of_end_placing > TIMESTAMP '2037-12-30 00:00:00'
            THEN TIMESTAMP '1970-01-01 04:00:01' ELSE date_of_end_placing END AS date_of_end_placing,
       CASE WHEN maturity_date > TIMESTAMP '2037-12-30 00:00:00'
            THEN TIMESTAMP '1970-01-01 04:00:01' ELSE maturity_date END AS maturity_date,
       usd_volume
FROM bl""")
def q_far_date_sentinel(spark, sf_dir):
    from ..functions.sentinel import apply_far_date_sentinel
    return apply_far_date_sentinel(_bonds(spark, sf_dir))


@register("anchor_date", """
SELECT event_id, ts, CAST(hour(m) AS INTEGER) AS local_hour,
       strftime(CASE WHEN hour(m) < 10 THEN CAST(m AS DATE) - 1 ELSE CAST(m AS DATE) END, '%Y%m%d')
         AS anchor_date
FROM (SELECT event_id, ts, timezone('Europe/Moscow', timezone('UTC', ts)) AS m FROM events)
""")
def q_anchor_date(spark, sf_dir):
    """Exchange-local hour and business anchor date of every event time."""
    from ..functions.timeutil import anchor_date, local_hour
    ev = P.table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", local_hour("ts").alias("local_hour"),
                     anchor_date("ts").alias("anchor_date"))


# ---------------------------------------------------------------------------
# Quote events: JSON payloads, snapshots, typed rows

SQL_EVENT_TEXT = """
ev_text AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id * 20 AS VARCHAR) AS bond,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS bid,
         CAST(CAST(value AS DECIMAL(18,2)) * CAST(1.01 AS DECIMAL(3,2)) AS VARCHAR) AS ask,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                              WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS VARCHAR) AS tg,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS "date",
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS update_ts,
         '0' AS volume,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS volume_money,
         '0' AS overturn
  FROM events
)"""

SQL_TYPED = """
q AS (
  SELECT CAST(user_id * 20 AS BIGINT) AS bond,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                              WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS BIGINT) AS tg,
         CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS volume_money,
         CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS bid,
         CAST(CAST(value AS DECIMAL(18,2)) * CAST(1.01 AS DECIMAL(3,2)) AS DOUBLE) AS ask,
         CAST(0 AS DOUBLE) AS overturn,
         CAST(ts AS DATE) AS "date",
         ts AS update_ts
  FROM events
)"""


@register("json_quote_parse_faulty", "WITH " + SQL_TYPED + """
SELECT bond, tg, volume_money, CASE WHEN tg = 4 THEN -1 ELSE bid END AS bid, ask, overturn, "date", update_ts
FROM q WHERE tg NOT IN (2, 5)""")
def q_json_quote_parse_faulty(spark, sf_dir):
    """Payloads cut short and unreadable keys drop out; an explicit null price stays null
    (shown as -1)."""
    from ..functions.jsonq import parse_quote_json
    from ..streaming.quotes import to_wall_clock
    typed = to_wall_clock(parse_quote_json(P.faulty_json(spark, sf_dir)))
    return typed.withColumn("bid", F.coalesce("bid", F.lit(-1.0)))


def _typed_quotes(spark, sf_dir):
    from ..functions.jsonq import parse_quote_json
    return parse_quote_json(P.intraday_json(spark, sf_dir))


@register("events_to_json", "WITH " + SQL_EVENT_TEXT + """
SELECT CAST(json_object('id', id, 'bond', bond, 'bid', bid, 'ask', ask, 'tg', tg, 'date', "date",
                        'update_ts', update_ts, 'volume', volume, 'volume_money', volume_money,
                        'overturn', overturn) AS VARCHAR) AS value
FROM ev_text""")
def q_events_to_json(spark, sf_dir):
    """Topic payloads: one JSON object per quote event, fields as strings."""
    return P.intraday_json(spark, sf_dir)


@register("json_quote_parse", "WITH " + SQL_TYPED + "\nSELECT * FROM q")
def q_json_quote_parse(spark, sf_dir):
    """Payload -> from_json -> flatten -> try_cast -> bond/tg filter."""
    from ..streaming.quotes import to_wall_clock
    return to_wall_clock(_typed_quotes(spark, sf_dir))


@register("snapshot_explode", "WITH " + SQL_EVENT_TEXT + "\nSELECT * FROM ev_text")
def q_snapshot_explode(spark, sf_dir):
    """Landed snapshot documents (written, then read as text) -> one event per item."""
    from ..sources.snapshot import read_snapshots, snapshot_explode
    path = S.scratch_dir(spark, "snapshots")
    P.snapshot_documents(P.table(spark, sf_dir, "events")).write.mode("overwrite").text(path)
    return snapshot_explode(read_snapshots(spark, path))


# ---------------------------------------------------------------------------
# Sliding windows, newest quote, enrichment (batch)

SQL_WINDOWS = SQL_TYPED + """,
qw AS (
  SELECT q.*, date_trunc('minute', update_ts) - to_minutes(k) AS window_start
  FROM q, range(0, 30) r(k)
),
win AS (
  SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, bond, tg, "date",
         round(sum(volume_money), 6) AS volume_money, max(bid) AS bid, max(ask) AS ask,
         max(update_ts) AS update_ts, count(update_ts) AS cnt
  FROM qw GROUP BY window_start, bond, tg, "date"
)"""

SQL_ENRICHED = SQL_METRICS + "," + SQL_WINDOWS + """,
enriched AS (
  SELECT win.window_start, win.window_end, win.bond, m.isin, win.tg, win."date", win.volume_money,
         win.bid, win.ask, win.update_ts, m.bid_ask_spread_relative_median AS baspread_rel_median,
         m.bid_ask_spread_relative_rank AS baspread_rel_rank, win.cnt
  FROM win LEFT JOIN metrics m ON m.id = win.bond
)"""

WATERMARK_CUT = "(SELECT max(ts) FROM events) - INTERVAL 120 MINUTE"


def _round_sum(df):
    # Sums of doubles depend on the order partial sums meet; compare at 1e-6.
    return df.withColumn("volume_money", F.round("volume_money", 6))


def _windows(spark, sf_dir, method=None):
    from ..operators.windows import sliding_window_agg
    from ..streaming.quotes import to_wall_clock
    win = sliding_window_agg(_typed_quotes(spark, sf_dir), method=method)
    return _round_sum(to_wall_clock(win))


@register("sliding_window_agg", "WITH " + SQL_WINDOWS + "\nSELECT * FROM win")
def q_sliding_window_agg(spark, sf_dir):
    """30-minute windows every minute per (bond, tg, date)."""
    return _windows(spark, sf_dir)


@register("window_single_observation", "WITH " + SQL_WINDOWS + "\nSELECT * FROM win WHERE cnt = 1")
def q_window_single_observation(spark, sf_dir):
    return _windows(spark, sf_dir).where(F.col("cnt") == 1)


SQL_LATEST = "WITH " + SQL_TYPED + """
SELECT bond, tg, volume_money, bid, ask, overturn, "date", update_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY bond, tg ORDER BY update_ts DESC NULLS LAST,
         volume_money DESC, bid DESC, ask DESC, overturn DESC, "date" DESC) AS rn
  FROM q) WHERE rn = 1"""


@register("latest_quote", SQL_LATEST)
def q_latest_quote(spark, sf_dir):
    """Newest quote per (bond, tg)."""
    from ..operators.windows import latest_quote
    from ..streaming.quotes import to_wall_clock
    return to_wall_clock(latest_quote(_typed_quotes(spark, sf_dir)))


def _materialized_metrics(spark, sf_dir):
    """Metrics written once as Parquet and read back: a lineage cut, and the
    static side of the enrichment is a table whose size a count bounds."""
    from ..sinks.writers import read_metrics_parquet, write_parquet
    # Unsorted: readers that need an order (notebook_head) sort on read.
    path = write_parquet(_metrics(spark, sf_dir, sort=False), S.scratch_dir(spark, "metrics"))
    return read_metrics_parquet(spark, path), path


@register("enriched_quotes_batch", "WITH " + SQL_ENRICHED + "\nSELECT * FROM enriched")
def q_enriched_quotes_batch(spark, sf_dir):
    """Batch twin of the stream: windows left-joined with the metrics."""
    from ..operators.windows import enriched_windows
    from ..streaming.quotes import to_wall_clock
    metrics, _ = _materialized_metrics(spark, sf_dir)
    return _round_sum(to_wall_clock(enriched_windows(_typed_quotes(spark, sf_dir), metrics)))


# ---------------------------------------------------------------------------
# Metric sinks read back

@register("metrics_parquet_roundtrip", "WITH " + SQL_METRICS + "\nSELECT * FROM metrics")
def q_metrics_parquet_roundtrip(spark, sf_dir):
    metrics, _ = _materialized_metrics(spark, sf_dir)
    return metrics


@register("metrics_csv_roundtrip", "WITH " + SQL_METRICS + "\nSELECT * FROM metrics")
def q_metrics_csv_roundtrip(spark, sf_dir):
    """Metrics written as header CSV and read back with the declared schema."""
    from ..sinks.writers import read_metrics_csv, write_csv
    path = write_csv(_metrics(spark, sf_dir), S.scratch_dir(spark, "metrics-csv"))
    return read_metrics_csv(spark, path)


@register("notebook_head", "WITH " + SQL_METRICS + "\nSELECT * FROM metrics ORDER BY id LIMIT 10")
def q_notebook_head(spark, sf_dir):
    """First ten metric rows of the Parquet copy (bounded, unlike a full toPandas)."""
    metrics, _ = _materialized_metrics(spark, sf_dir)
    return metrics.orderBy("id").limit(10)


SQL_LAST_YEAR = """(SELECT strftime(max(date_trunc('year', l_shipdate)), '%Y%m%d') FROM lineitem)"""


@register("metrics_latest_anchor", "WITH " + SQL_METRICS + f"\nSELECT *, {SQL_LAST_YEAR} AS anchor_date FROM metrics")
def q_metrics_latest_anchor(spark, sf_dir):
    """Three daily copies as partitions of one table, each of the quotes up to its day; the newest day is written
    neither last nor once. Read back: the newest day. The copies share one table of daily medians: the quotes are
    read and shuffled once, not once a copy."""
    from ..sinks.writers import read_newest_metrics, write_metrics_day, write_parquet
    path, medians = S.scratch_dir(spark, "metrics-days"), S.scratch_dir(spark, "daily-medians")
    daily = spark.read.parquet(write_parquet(liquidity.daily_medians(_exchange(spark, sf_dir)), medians))
    days = [r[0] for r in daily.select("date").distinct().orderBy(F.col("date").desc()).limit(3).collect()]
    for day in [days[0], *days[:0:-1], days[0], *days[1:2]] if days else []:
        metrics = liquidity.metrics_of_daily(daily.where(F.col("date") <= F.lit(day)), _bonds(spark, sf_dir), sort=False)
        write_metrics_day(metrics, path, day.strftime("%Y%m%d"))
    S.remove_scratch(spark, medians)
    return read_newest_metrics(spark, path)


# ---------------------------------------------------------------------------
# Large sides bucketed by bond

def _buckets(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@register("bucketed_bond_rank", "WITH " + SQL_METRICS + "\nSELECT * FROM metrics")
def q_bucketed_bond_rank(spark, sf_dir):
    """The bond list and the ranks, both written in buckets of the bond, joined without a shuffle."""
    from ..sinks.bucketed import join_bucketed, write_bucketed, write_bucketed_lookup
    ranks = liquidity.rank_by_median(liquidity.spread_medians(_exchange(spark, sf_dir)))
    listed = write_bucketed(_bonds(spark, sf_dir), S.scratch_dir(spark, "bucketed-bonds"), "id", _buckets(spark))
    ranked = write_bucketed_lookup(ranks, S.scratch_dir(spark, "bucketed-ranks"), "bond", _buckets(spark))
    return join_bucketed(spark, listed, ranked).select(*liquidity.METRIC_COLUMNS)


@register("bucketed_enrichment", "WITH " + SQL_METRICS + "," + SQL_TYPED + """
SELECT q.*, m.isin, m.bid_ask_spread_relative_median AS baspread_rel_median, m.bid_ask_spread_relative_rank AS baspread_rel_rank
FROM q LEFT JOIN metrics m ON m.id = q.bond""")
def q_bucketed_enrichment(spark, sf_dir):
    """Every typed quote with its bond's metrics, both sides bucketed; the quotes of a bond lie in eight
    buckets, so a bond with most of them is not one task."""
    from ..sinks.bucketed import join_bucketed, write_bucketed, write_bucketed_lookup
    from ..streaming.quotes import to_wall_clock
    metrics = _metrics(spark, sf_dir, sort=False).select(
        "id", "isin", F.col("bid_ask_spread_relative_median").alias("baspread_rel_median"),
        F.col("bid_ask_spread_relative_rank").alias("baspread_rel_rank"))
    quotes = write_bucketed(to_wall_clock(_typed_quotes(spark, sf_dir)), S.scratch_dir(spark, "bucketed-quotes"), "bond", _buckets(spark), salts=8)
    lookup = write_bucketed_lookup(metrics, S.scratch_dir(spark, "bucketed-metrics"), "id", _buckets(spark), salts=8)
    return join_bucketed(spark, quotes, lookup, "left").drop("id")


# ---------------------------------------------------------------------------
# Streaming (file source standing in for the topic; availableNow, then read back)

def _event_stream(spark, sf_dir):
    from ..functions.jsonq import quote_events_to_json
    from ..streaming.quotes import file_source
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    raw = file_source(spark, sf_dir, schema, glob="events.parquet")
    # One landed file is one split; spread each micro-batch over the cores
    # (a topic source would arrive already split by partition).
    raw = raw.repartition(spark.sparkContext.defaultParallelism)
    return quote_events_to_json(P.intraday_events(raw))


def _state_partitions(spark):
    # The test streams hold at most a few million window states: one state
    # partition per core.
    return spark.sparkContext.defaultParallelism


def _run_stream(spark, stream, name):
    from ..streaming.runner import run_available_now
    out = S.scratch_dir(spark, name)
    run_available_now(stream, out, f"{out}/_checkpoint", state_partitions=_state_partitions(spark))
    return spark.read.parquet(out)


@register("stream_file_source", "WITH " + SQL_TYPED + "\nSELECT * FROM q")
def q_stream_file_source(spark, sf_dir):
    """Stream of topic values from landed files, parsed and typed."""
    from ..functions.jsonq import parse_quote_json
    from ..streaming.quotes import to_wall_clock
    typed = parse_quote_json(_event_stream(spark, sf_dir))
    return to_wall_clock(_run_stream(spark, typed, "stream-source"))


@register("stream_sliding_window", "WITH " + SQL_WINDOWS +
          f"\nSELECT * FROM win WHERE window_end <= {WATERMARK_CUT}")
def q_stream_sliding_window(spark, sf_dir):
    """Watermarked sliding windows in append mode: windows closed by the watermark."""
    from ..streaming.quotes import to_wall_clock, windowed_quotes
    out = _run_stream(spark, windowed_quotes(_event_stream(spark, sf_dir)), "stream-windows")
    return _round_sum(to_wall_clock(out))


def _chained(spark, sf_dir):
    from ..streaming.quotes import chained_quotes
    from ..streaming.runner import run_available_now
    out = S.scratch_dir(spark, "stream-chained")
    run_available_now(chained_quotes(_event_stream(spark, sf_dir)), out, f"{out}/_checkpoint", state_partitions=_state_partitions(spark))
    return out


@register("stream_chained_windows", "WITH " + SQL_WINDOWS +
          f"\nSELECT * FROM win WHERE window_end <= {WATERMARK_CUT}")
def q_stream_chained_windows(spark, sf_dir):
    """The same windows by two stateful operators: per minute, then 30 minutes every minute."""
    from ..streaming.quotes import to_wall_clock
    return _round_sum(to_wall_clock(spark.read.parquet(_chained(spark, sf_dir))))


@register("stream_chained_state", "WITH " + SQL_TYPED + f""",
minutes AS (SELECT DISTINCT date_trunc('minute', update_ts) AS m, bond, tg, "date" FROM q),
open AS (SELECT * FROM minutes WHERE m + INTERVAL 1 MINUTE > {WATERMARK_CUT}),
begun AS (SELECT DISTINCT m - to_minutes(k) AS w, bond, tg, "date" FROM minutes, range(0, 30) r(k) WHERE m + INTERVAL 1 MINUTE <= {WATERMARK_CUT})
SELECT 'minutes' AS held, count(*) AS state_rows FROM open
UNION ALL SELECT 'windows', count(*) FROM begun WHERE w + INTERVAL 30 MINUTE > {WATERMARK_CUT}""")
def q_stream_chained_state(spark, sf_dir):
    """What each of the two operators still holds at the end, from the state store: minutes not yet closed,
    and open windows with a closed minute."""
    from ..streaming.runner import state_rows
    out = _chained(spark, sf_dir)
    # Operators are numbered from the output back.
    windows, minutes = (state_rows(spark, f"{out}/_checkpoint", operator).agg(F.count(F.lit(1)).alias("state_rows")) for operator in (0, 1))
    return minutes.select(F.lit("minutes").alias("held"), "state_rows").unionByName(windows.select(F.lit("windows").alias("held"), "state_rows"))


def _enriched_stream_output(spark, sf_dir):
    from ..streaming.quotes import enriched_quotes, to_wall_clock
    metrics, _ = _materialized_metrics(spark, sf_dir)
    out = _run_stream(spark, enriched_quotes(_event_stream(spark, sf_dir), metrics),
                      "stream-enriched")
    return _round_sum(to_wall_clock(out))


ENRICHED_COLS_SQL = ("bond, isin, tg, \"date\", volume_money, bid, ask, update_ts, "
                     "baspread_rel_median, baspread_rel_rank, cnt")


@register("stream_enriched_quotes", "WITH " + SQL_ENRICHED +
          f"\nSELECT {ENRICHED_COLS_SQL} FROM enriched WHERE window_end <= {WATERMARK_CUT}")
def q_stream_enriched_quotes(spark, sf_dir):
    """Full stream: windows x broadcast metrics, window column dropped, file sink read back."""
    return _enriched_stream_output(spark, sf_dir)


@register("stream_sink_readback", "WITH " + SQL_ENRICHED +
          f"\nSELECT {ENRICHED_COLS_SQL} FROM enriched WHERE window_end <= {WATERMARK_CUT}")
def q_stream_sink_readback(spark, sf_dir):
    """The stream's output folder read back through the sink's commit log, so files
    of a failed attempt don't count."""
    from ..streaming.quotes import enriched_quotes, to_wall_clock
    from ..streaming.runner import run_available_now
    metrics, _ = _materialized_metrics(spark, sf_dir)
    out = S.scratch_dir(spark, "stream-readback")
    run_available_now(enriched_quotes(_event_stream(spark, sf_dir), metrics), out,
                      f"{out}/_checkpoint", state_partitions=_state_partitions(spark))
    return _round_sum(to_wall_clock(spark.read.parquet(out)))


@register("stream_sink_count", "WITH " + SQL_ENRICHED +
          f"\nSELECT count(*) AS n_rows FROM enriched WHERE window_end <= {WATERMARK_CUT}")
def q_stream_sink_count(spark, sf_dir):
    return _enriched_stream_output(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


@register("newest_enriched_top10", "WITH " + SQL_ENRICHED + f"""
SELECT {ENRICHED_COLS_SQL} FROM enriched WHERE window_end <= {WATERMARK_CUT}
ORDER BY update_ts DESC NULLS LAST, bond ASC NULLS FIRST, tg ASC NULLS FIRST, "date" ASC NULLS FIRST,
         cnt DESC NULLS LAST, volume_money DESC NULLS LAST, bid DESC NULLS LAST, ask DESC NULLS LAST
LIMIT 10""")
def q_newest_enriched_top10(spark, sf_dir):
    """Ten newest enriched rows (top-k; ties broken by the remaining columns)."""
    out = _enriched_stream_output(spark, sf_dir)
    return out.orderBy(F.col("update_ts").desc_nulls_last(), F.col("bond").asc_nulls_first(),
                       F.col("tg").asc_nulls_first(), F.col("date").asc_nulls_first(),
                       F.col("cnt").desc_nulls_last(), F.col("volume_money").desc_nulls_last(),
                       F.col("bid").desc_nulls_last(), F.col("ask").desc_nulls_last()).limit(10)


# ---------------------------------------------------------------------------
# Late rows, restart, failure and upsert: all events landed as text files in several parts, one
# run (a new query on the same checkpoint) after each

def _land(spark, sf_dir, folder, test):
    """Write the topic payloads of the events of a condition as new files of ``folder``. A
    condition that is null for an event does not hold."""
    from ..functions.jsonq import quote_events_to_json
    events = P.table(spark, sf_dir, "events").where(test)
    quote_events_to_json(P.intraday_events(events)).select("value").write.mode("append").text(folder)


def _landed_stream(spark, folder):
    from ..streaming.quotes import file_source
    from pyspark.sql.types import StringType, StructField, StructType
    return file_source(spark, folder, StructType([StructField("value", StringType())]), fmt="text")


def _is(*kinds):
    return F.coalesce(F.col("event_type").isin(*kinds), F.lit(False))


def _late_parts():
    return [_is("view"), _is("click"), ~_is("view", "click")]


def _late_runs(spark, sf_dir):
    """Views arrive first, clicks next, all other events last, each in a run of its own: a run
    drops the windows that the runs before it have closed. Returns the output folder and the
    windows dropped by each run."""
    from ..streaming.quotes import windowed_quotes
    from ..streaming.runner import dropped_by_watermark, run_available_now
    folder, out = S.scratch_dir(spark, "late-landing"), S.scratch_dir(spark, "late-windows")
    dropped = []
    for part in _late_parts():
        _land(spark, sf_dir, folder, part)
        query = run_available_now(windowed_quotes(_landed_stream(spark, folder)), out, f"{out}/_checkpoint",
                                  state_partitions=_state_partitions(spark))
        dropped.append(dropped_by_watermark(query))
    S.remove_scratch(spark, folder)
    return out, dropped


# The watermark that a run meets: of views for clicks, of views and clicks for all others.
SQL_LATE = SQL_WINDOWS + """,
late AS (
  SELECT win.*, CASE WHEN tg = 5 THEN 1 WHEN tg = 1 THEN 2 ELSE 3 END AS run,
         CASE WHEN tg = 5 THEN false
              WHEN tg = 1 THEN window_end <= (SELECT max(ts) FROM events WHERE event_type = 'view') - INTERVAL 120 MINUTE
              ELSE window_end <= (SELECT max(ts) FROM events WHERE event_type IN ('view', 'click')) - INTERVAL 120 MINUTE END AS dropped
  FROM win
)"""


@register("late_rows_dropped", "WITH " + SQL_LATE + f"""
SELECT window_start, window_end, bond, tg, "date", volume_money, bid, ask, update_ts, cnt
FROM late WHERE NOT dropped AND window_end <= {WATERMARK_CUT}""")
def q_late_rows_dropped(spark, sf_dir):
    """Windows written by three runs of which the later ones bring late rows."""
    from ..streaming.quotes import to_wall_clock
    out, _ = _late_runs(spark, sf_dir)
    return _round_sum(to_wall_clock(spark.read.parquet(out)))


@register("late_windows_counted", "WITH " + SQL_LATE + """
SELECT run, count(*) FILTER (dropped) AS windows_dropped FROM (SELECT run, dropped FROM late UNION ALL SELECT unnest([1, 2, 3]), false)
GROUP BY run""")
def q_late_windows_counted(spark, sf_dir):
    """What each run lost behind the watermark, from the progress that the query reports."""
    _, dropped = _late_runs(spark, sf_dir)
    return spark.createDataFrame(list(enumerate(dropped, 1)), "run int, windows_dropped bigint")


def _halves(spark, sf_dir):
    """Conditions for the earlier and the later half of the events (by time; no time counts as early)."""
    at = F.col("ts").cast("timestamp").cast("double")
    middle = P.table(spark, sf_dir, "events").agg(F.percentile_approx(at, 0.5)).first()[0]
    late = F.coalesce(at > F.lit(middle), F.lit(False))
    return ~late, late


@register("restart_from_checkpoint", "WITH " + SQL_WINDOWS +
          f"\nSELECT * FROM win WHERE window_end <= {WATERMARK_CUT}")
def q_restart_from_checkpoint(spark, sf_dir):
    """Two runs on one checkpoint, the second after the later events have landed: the
    state of the first carries on, no window is lost or written twice."""
    from ..streaming.quotes import to_wall_clock, windowed_quotes
    from ..streaming.runner import run_available_now
    folder, out = S.scratch_dir(spark, "restart-landing"), S.scratch_dir(spark, "restart-windows")
    for part in _halves(spark, sf_dir):
        _land(spark, sf_dir, folder, part)
        run_available_now(windowed_quotes(_landed_stream(spark, folder)), out, f"{out}/_checkpoint",
                          state_partitions=_state_partitions(spark))
    S.remove_scratch(spark, folder)
    return _round_sum(to_wall_clock(spark.read.parquet(out)))


def _run_failing_once(spark, make_stream, checkpoint, write, output_mode="append", state_partitions=None):
    """Runs a stream into ``write`` (batch, id), which breaks off once after it has written; then
    runs it again on the same checkpoint, which replays the broken batch."""
    from ..streaming.runner import run_available_now
    broken = []

    def breaking(batch, batch_id):
        write(batch, batch_id)
        if not broken:
            broken.append(batch_id)
            raise RuntimeError("broken off on purpose")

    for attempt in (1, 2):
        try:
            run_available_now(make_stream(), None, checkpoint, output_mode=output_mode, foreach_batch=breaking, state_partitions=state_partitions)
        except Exception:
            if attempt == 2 or not broken:
                raise


def _failed_and_recovered(spark, sf_dir):
    """The two halves, with a failure inside the second one's first batch. Batches go to folders of
    their own number, so a replayed one replaces what the broken one left. Returns (output, checkpoint)."""
    from ..streaming.quotes import windowed_quotes
    from ..streaming.runner import run_available_now
    folder, out, checkpoint = (S.scratch_dir(spark, f"failure-{x}") for x in ("landing", "windows", "checkpoint"))
    write = lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    stream = lambda: windowed_quotes(_landed_stream(spark, folder))
    n = _state_partitions(spark)
    early, late = _halves(spark, sf_dir)
    _land(spark, sf_dir, folder, early)
    run_available_now(stream(), None, checkpoint, foreach_batch=write, state_partitions=n)
    _land(spark, sf_dir, folder, late)
    _run_failing_once(spark, stream, checkpoint, write, state_partitions=n)
    S.remove_scratch(spark, folder)
    return out, checkpoint


@register("recovery_after_failed_batch", "WITH " + SQL_WINDOWS +
          f"\nSELECT * FROM win WHERE window_end <= {WATERMARK_CUT}")
def q_recovery_after_failed_batch(spark, sf_dir):
    """A batch fails after it has written and is replayed: no window is lost or doubled."""
    from ..streaming.quotes import to_wall_clock
    out, checkpoint = _failed_and_recovered(spark, sf_dir)
    S.remove_scratch(spark, checkpoint)
    return _round_sum(to_wall_clock(spark.read.parquet(out).drop("batch")))


@register("open_windows_in_state", "WITH " + SQL_WINDOWS +
          f"""\nSELECT window_start, window_end, bond, tg, "date", cnt, update_ts FROM win WHERE window_end > {WATERMARK_CUT}""")
def q_open_windows_in_state(spark, sf_dir):
    """The windows that are still open after the replay, read from the state store."""
    from ..streaming.quotes import to_wall_clock
    from ..streaming.runner import state_rows
    out, checkpoint = _failed_and_recovered(spark, sf_dir)
    rows = state_rows(spark, checkpoint)
    key, held = rows.schema["key"].dataType.names, rows.schema["value"].dataType.names
    # Buffers in the order of the aggregates: sum (total, or total and whether empty), max bid, max ask, max time, count.
    frame, *names = [F.col("key").getField(k) for k in key]
    return to_wall_clock(rows.select(
        frame["start"].alias("window_start"), frame["end"].alias("window_end"), *[n.alias(k) for n, k in zip(names, ("bond", "tg", "date"))],
        F.col("value").getField(held[-1]).alias("cnt"), F.col("value").getField(held[-2]).alias("update_ts")))


SQL_UPSERT = "WITH " + SQL_TYPED + """
SELECT bond, tg, "date", volume_money, bid, ask, overturn, update_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY bond, tg, "date" ORDER BY update_ts DESC NULLS LAST,
         volume_money DESC, bid DESC, ask DESC, overturn DESC) AS rn
  FROM q) WHERE rn = 1"""
UPSERT_NAMES = ["bond", "tg", "date", "volume_money", "bid", "ask", "overturn", "update_ts"]


def _upsert_parts():
    return [_is("view", "error"), _is("click"), ~_is("view", "error", "click")]


@register("upsert_latest", SQL_UPSERT)
def q_upsert_latest(spark, sf_dir):
    """Typed quotes upserted into a date-partitioned table in three runs."""
    from ..functions.jsonq import parse_quote_json
    from ..sinks.upsert import read_upserted, upsert_writer
    from ..streaming.quotes import to_wall_clock
    from ..streaming.runner import run_available_now
    folder, target, progress = (S.scratch_dir(spark, f"upsert-{x}") for x in ("landing", "table", "checkpoint"))
    for part in _upsert_parts():
        _land(spark, sf_dir, folder, part)
        run_available_now(parse_quote_json(_landed_stream(spark, folder)), None, progress,
                          output_mode="update", foreach_batch=upsert_writer(target))
    for used in (folder, progress):
        S.remove_scratch(spark, used)
    return to_wall_clock(read_upserted(spark, target)).select(*UPSERT_NAMES)


@register("upsert_after_crash", SQL_UPSERT)
def q_upsert_after_crash(spark, sf_dir):
    """The same, but every run breaks off in its commit: once with the rows written and the version
    not switched, once after the switch. The stream replays the batch; stale folders are deleted."""
    from ..functions.jsonq import parse_quote_json
    from ..sinks import upsert
    from ..streaming.quotes import to_wall_clock
    from ..streaming.runner import run_available_now
    folder, target, progress = (S.scratch_dir(spark, f"crash-{x}") for x in ("landing", "table", "checkpoint"))
    stream = lambda: parse_quote_json(_landed_stream(spark, folder))
    real, write = upsert._switch, upsert.upsert_writer(target)
    for k, part in enumerate(_upsert_parts()):
        _land(spark, sf_dir, folder, part)
        if k % 2:
            _run_failing_once(spark, stream, progress, write, "update")
            continue
        upsert._switch = _broken_off
        try:
            run_available_now(stream(), None, progress, output_mode="update", foreach_batch=write)
        except Exception as e:
            if "broken off on purpose" not in str(e):
                raise
        finally:
            upsert._switch = real
        run_available_now(stream(), None, progress, output_mode="update", foreach_batch=write)
    upsert.vacuum(spark, target)
    for used in (folder, progress):
        S.remove_scratch(spark, used)
    return to_wall_clock(upsert.read_upserted(spark, target)).select(*UPSERT_NAMES)


def _broken_off(*_):
    raise RuntimeError("broken off on purpose")


# ---------------------------------------------------------------------------
# Newest quote and republished snapshots on streams

@register("stream_latest_quote", SQL_LATEST)
def q_stream_latest_quote(spark, sf_dir):
    """Newest quote per (bond, tg) as an unwindowed state in update mode, kept in an upserted table; the
    query is started anew for each of three landed parts, which are not in the order of time."""
    from ..functions.jsonq import parse_quote_json
    from ..operators.windows import latest_quote
    from ..sinks.upsert import read_upserted, upsert_writer
    from ..streaming.quotes import to_wall_clock
    from ..streaming.runner import run_available_now
    folder, target, progress = (S.scratch_dir(spark, f"latest-{x}") for x in ("landing", "table", "checkpoint"))
    write = upsert_writer(target, keys=("bond", "tg"), partition_col="tg")
    early, late = _halves(spark, sf_dir)
    for part in (late & _is("view", "click"), early, late & ~_is("view", "click")):
        _land(spark, sf_dir, folder, part)
        run_available_now(latest_quote(parse_quote_json(_landed_stream(spark, folder))), None, progress, output_mode="update",
                          foreach_batch=write, state_partitions=_state_partitions(spark))
    for used in (folder, progress):
        S.remove_scratch(spark, used)
    return to_wall_clock(read_upserted(spark, target)).select("bond", "tg", "volume_money", "bid", "ask", "overturn", "date", "update_ts")


@register("stream_snapshot_events", "WITH " + SQL_EVENT_TEXT + "\nSELECT DISTINCT * FROM ev_text")
def q_stream_snapshot_events(spark, sf_dir):
    """Four polls, each repeating the whole quarter of the one before: snapshots land as
    documents, one a file, and every event comes out once."""
    from ..sources.snapshot import published_once, snapshot_explode, snapshot_stream
    from ..streaming.runner import run_available_now
    folder, out = S.scratch_dir(spark, "poll-landing"), S.scratch_dir(spark, "poll-events")
    at = F.col("ts").cast("timestamp").cast("double")
    events = P.table(spark, sf_dir, "events")
    cuts = events.agg(F.percentile_approx(at, [0.25, 0.5, 0.75])).first()[0] or [0.0] * 3
    quarter = F.lit(0)
    for cut in cuts:
        quarter = quarter + F.when(at > F.lit(cut), 1).otherwise(0)
    for poll in range(4):
        docs = P.snapshot_documents(events.where(quarter.isin(poll - 1, poll)))
        docs.write.mode("append").option("maxRecordsPerFile", 1).text(folder)
        stream = published_once(snapshot_explode(snapshot_stream(spark, folder)), "3650 days")
        run_available_now(stream.drop("event_time"), out, f"{out}/_checkpoint", state_partitions=_state_partitions(spark))
    S.remove_scratch(spark, folder)
    return spark.read.parquet(out)


def bench_variants() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Alternative strategies timed by bench.py next to the registered queries."""
    def sliding_window_preagg(spark, sf_dir):
        S.prepare(spark)
        return _windows(spark, sf_dir, method="buckets")
    def sliding_window_plain(spark, sf_dir):
        S.prepare(spark)
        return _windows(spark, sf_dir, method="plain")
    def liquidity_metrics_salted_kll(spark, sf_dir):
        S.prepare(spark)
        return liquidity.liquidity_metrics(_exchange(spark, sf_dir), _bonds(spark, sf_dir),
                                           method="kll", salt_buckets=4)
    def liquidity_metrics_exact(spark, sf_dir):
        S.prepare(spark)
        return liquidity.liquidity_metrics(_exchange(spark, sf_dir), _bonds(spark, sf_dir), method="exact")
    return {"sliding_window_preagg": sliding_window_preagg,
            "sliding_window_plain": sliding_window_plain,
            "liquidity_metrics_salted_kll": liquidity_metrics_salted_kll,
            "liquidity_metrics_exact": liquidity_metrics_exact}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.fn for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.oracle for name, q in REGISTRY.items() if q.oracle}
