"""Cleaning and typing of the three batch inputs, and OTC bid/ask pairing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import (BONDS, EXCHANGE, OTC_KEYS, OTC_PAIRED, REJECT_COL, enforce_schema, split_quarantine,
                       typed_select)

# Fixed values of the original job: trading grounds left out of the spread.
EXCLUDED_GROUNDS = (327, 381)
# OTC quote sides.
OTC_BID, OTC_ASK = 1, 2


def _not_null(df: DataFrame, cols: Iterable[str]):
    cond = None
    for c in cols:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return cond


def clean_exchange_quotes(raw: DataFrame, excluded_grounds: Iterable[int] = EXCLUDED_GROUNDS,
                          mode: str = "drop", observation: Observation | None = None) -> DataFrame:
    """Exchange quotes -> (bond, tg, date, bid, ask), typed, non-null.

    Raw nulls are filtered first (pushed to the scan), excluded trading grounds
    are removed, then the typed non-null contract is enforced in ``mode``. With
    typed (Parquet) input every cast is a no-op and Catalyst drops it.
    """
    keep = raw.where(_not_null(raw, ["bond", "tg", "date", "bid", "ask"]))
    typed = typed_select(keep, EXCHANGE)
    excluded = list(excluded_grounds)
    if excluded:
        typed = typed.where(~F.col("tg").isin(excluded) | F.col("tg").isNull())
    return enforce_schema(typed, EXCHANGE, mode, observation)


def clean_bonds(raw: DataFrame, mode: str = "drop", observation: Observation | None = None) -> DataFrame:
    """Bond list -> (id, isin, date_of_end_placing, maturity_date, usd_volume)."""
    keep = raw.where(_not_null(raw, ["id", "isin_code"]))
    typed = typed_select(keep, BONDS, renames={"isin": "isin_code"})
    return enforce_schema(typed, BONDS, mode, observation)


def otc_side(raw: DataFrame, quote_type: int, price_name: str, mode: str, observation: Observation | None = None) -> DataFrame:
    """One side, typed, with its non-null contract enforced in ``mode`` before
    any join could drop a bad key. Unpriced quotes (price null or not above 0)
    are left out in every mode."""
    side = raw.where(_not_null(raw, ["bond", "org", "date", "price"]))
    side = side.where(F.col("quote_type").try_cast("int") == quote_type)
    side = side.withColumn(price_name, F.col("price").try_cast("double")).where(F.col(price_name) > 0)
    keys = [F.col(f.name).try_cast(f.dataType) for f in OTC_KEYS.fields]
    if mode == "assert":
        # Inside the key, not a filter beside it: the join's own null checks would run first.
        return side.select(*[F.coalesce(k, F.raise_error(F.lit(f"OTC quote with a bad {f.name}")).cast(f.dataType)).alias(f.name)
                             for k, f in zip(keys, OTC_KEYS.fields)], price_name)
    typed = side.select(*[k.alias(f.name) for k, f in zip(keys, OTC_KEYS.fields)], price_name)
    return enforce_schema(typed, OTC_KEYS, mode, observation)


def pair_otc_quotes(raw: DataFrame, mode: str = "drop", observations: tuple[Observation, Observation] | None = None) -> DataFrame:
    """OTC quotes arrive one side per row; pair every bid with every ask of the
    same (bond, org, date).

    An equi-join: n bids and m asks on one key give n*m rows, a key with one
    side only gives none. Both sides are filtered (price > 0) before the join,
    so only priced quotes shuffle; a hot key is split by AQE's skew-join
    handling rather than landing whole in one task.

    A priced quote whose key doesn't cast is dropped, fails the job
    (``assert``), or (``quarantine``) comes out unpaired with its broken fields.
    ``observations`` (of bids, of asks) count the rejects; not with ``assert``, which has none.
    """
    of_bids, of_asks = observations or (None, None)
    bids = otc_side(raw, OTC_BID, "bid", mode, of_bids)
    asks = otc_side(raw, OTC_ASK, "ask", mode, of_asks)
    names = [f.name for f in OTC_PAIRED.fields]
    if mode != "quarantine":
        return bids.join(asks, ["bond", "org", "date"], "inner").select(*names)
    good_bids, bad_bids = split_quarantine(bids)
    good_asks, bad_asks = split_quarantine(asks)
    pairs = good_bids.join(good_asks, ["bond", "org", "date"], "inner")
    none = F.lit(None).cast("double")
    return (pairs.withColumn(REJECT_COL, F.array().cast("array<string>"))
            .unionByName(bad_bids.withColumn("ask", none)).unionByName(bad_asks.withColumn("bid", none))
            .select(*names, REJECT_COL))
