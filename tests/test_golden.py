"""Hand-worked rows (FIXTURES.md §4, G1, G2, G4, G5)."""

import datetime as dt

import pytest
from pyspark.sql.types import (DoubleType, LongType, StructField, StructType,
                               TimestampNTZType)

from liqspark.functions.sentinel import apply_far_date_sentinel
from liqspark.functions.timeutil import anchor_date
from liqspark.operators import clean, liquidity
from liqspark.schemas import RAW_EXCHANGE
from liqspark.sources.snapshot import snapshot_explode

D1 = dt.datetime(2019, 10, 1)
D2 = dt.datetime(2019, 10, 2)

EX_TYPED = StructType([
    StructField("bond", LongType()), StructField("tg", LongType()),
    StructField("date", TimestampNTZType()), StructField("bid", DoubleType()),
    StructField("ask", DoubleType()),
])

G1_ROWS = [
    (1, 20, D1, 99.0, 101.0), (1, 30, D1, 98.0, 102.0), (1, 40, D1, 97.0, 103.0),
    (1, 20, D2, 99.5, 100.5), (1, 327, D2, 50.0, 150.0), (2, 20, D1, 95.0, 105.0),
    (2, 20, D2, 0.0, 0.0), (3, 20, D1, 0.0, 0.0), (4, 20, D1, 99.0, 101.0),
    (5, 20, D1, 101.0, 99.0), (6, 20, D1, 99.0, 101.0), (4, 20, D1, None, 101.0),
]


def _ranks(spark, rows=G1_ROWS):
    ex = clean.clean_exchange_quotes(spark.createDataFrame(rows, EX_TYPED))
    out = liquidity.rank_by_median(liquidity.spread_medians(ex), num_partitions=3)
    return {r.bond: (r.bid_ask_spread_relative_median, r.bid_ask_spread_relative_rank)
            for r in out.collect()}


def test_g1_medians_and_ranks(spark):
    got = _ranks(spark)
    assert set(got) == {1, 2, 3, 4, 5, 6}
    expect = {2: (0.10, 1 / 6), 4: (0.02, 2 / 6), 6: (0.02, 3 / 6), 1: (0.01, 4 / 6),
              5: (-0.02, 5 / 6), 3: (None, 6 / 6)}
    for bond, (med, rank) in expect.items():
        gmed, grank = got[bond]
        if med is None:
            assert gmed is None
        else:
            assert gmed == pytest.approx(med, abs=1e-12)
        assert grank == pytest.approx(rank)


def test_g1_join_with_bond_list(spark):
    ex = clean.clean_exchange_quotes(spark.createDataFrame(G1_ROWS, EX_TYPED))
    bonds_raw = spark.createDataFrame(
        [(b, f"XS{b:010d}", None, None, None) for b in (1, 2, 3, 4, 5, 7)],
        "id long, isin_code string, date_of_end_placing timestamp_ntz, "
        "maturity_date timestamp_ntz, usd_volume double")
    metrics = liquidity.liquidity_metrics(ex, clean.clean_bonds(bonds_raw), num_partitions=2)
    rows = metrics.collect()
    assert [r.id for r in rows] == [1, 2, 3, 4, 5]  # ordered by id; 6 unlisted, 7 unquoted
    ranks = {r.id: r.bid_ask_spread_relative_rank for r in rows}
    assert ranks == pytest.approx({2: 1 / 6, 4: 2 / 6, 1: 4 / 6, 5: 5 / 6, 3: 1.0})


def test_g2_otc_pairing(spark):
    d1 = dt.datetime(2019, 10, 1)
    raw = spark.createDataFrame([
        (1, 10, d1, 1, 99.0), (1, 10, d1, 1, 98.0), (1, 10, d1, 2, 101.0), (1, 10, d1, 2, 102.0),
        (1, 11, d1, 1, 99.0), (2, 10, d1, 1, 0.0), (2, 10, d1, 2, 5.0), (3, 10, d1, 3, 5.0),
    ], "bond long, org long, date timestamp_ntz, quote_type int, price double")
    got = sorted((r.bond, r.org, r.bid, r.ask) for r in clean.pair_otc_quotes(raw).collect())
    assert got == [(1, 10, 98.0, 101.0), (1, 10, 98.0, 102.0),
                   (1, 10, 99.0, 101.0), (1, 10, 99.0, 102.0)]


def test_g4_snapshot_defaults_and_nulls(spark):
    doc = ('{"count":2,"items":[{"id":"20201","emission_id":"238","buying_quote":"168.6"},'
           '{"id":"2","trading_ground_id":null}]}')
    bad = ['{"items":[{"id":"9"}]}', '{"count":1,"items":"not a list"}',
           '{"count":3,"items":[5,"x",{"id":"7","emission_id":238}]}', 'not json']
    docs = spark.createDataFrame([(d,) for d in [doc] + bad], "value string")
    rows = {r.id: r for r in snapshot_explode(docs).collect()}
    assert set(rows) == {"20201", "2", "7"}
    a, b, c = rows["20201"], rows["2"], rows["7"]
    assert (a.bond, a.tg, a.bid, a.ask) == ("238", "0", "168.6", "0")
    assert (a.date, a.update_ts) == ("1970-01-01", "1970-01-01T00:00:00")
    assert (b.bond, b.tg) == ("0", None)
    assert c.bond == "238"  # a JSON number read as text


def test_g5_bad_cast_drop_and_assert(spark):
    raw = spark.createDataFrame([("abc", "20", "2019-10-01", "99", "101"),
                                 ("1", "20", "2019-10-01", "99", "101")], RAW_EXCHANGE)
    kept = clean.clean_exchange_quotes(raw, mode="drop").collect()
    assert [r.bond for r in kept] == [1]
    with pytest.raises(Exception, match="strict schema violated"):
        clean.clean_exchange_quotes(raw, mode="assert").collect()


def test_g5_quarantine_tags_rejected_fields(spark):
    from liqspark.schemas import REJECT_COL, split_quarantine
    raw = spark.createDataFrame([("abc", "20", "2019-10-01", "x", "101"),
                                 ("1", "20", "2019-10-01", "99", "101")], RAW_EXCHANGE)
    good, bad = split_quarantine(clean.clean_exchange_quotes(raw, mode="quarantine"))
    assert [r.bond for r in good.collect()] == [1]
    assert [sorted(r[REJECT_COL]) for r in bad.collect()] == [["bid", "bond"]]


def test_g5_json_number_and_non_json(spark):
    from liqspark.functions.jsonq import parse_quote_json
    vals = ['{"bond":238,"tg":"20","update_ts":"2019-10-01T14:32:55","date":"2019-10-01"}',
            'garbage', '{"bond":"abc","tg":"1"}']
    rows = parse_quote_json(spark.createDataFrame([(v,) for v in vals], "value string")).collect()
    assert len(rows) == 1 and rows[0].bond == 238 and rows[0].tg == 20
    assert rows[0].update_ts == dt.datetime(2019, 10, 1, 14, 32, 55)
    assert rows[0].date == dt.date(2019, 10, 1)


def test_g5_far_date_sentinel(spark):
    df = spark.createDataFrame([(dt.datetime(2040, 1, 1),), (dt.datetime(2037, 12, 30),), (None,)],
                               StructType([StructField("maturity_date", TimestampNTZType())]))
    got = [r.maturity_date for r in apply_far_date_sentinel(df, ["maturity_date"]).collect()]
    assert got == [dt.datetime(1970, 1, 1, 4, 0, 1), dt.datetime(2037, 12, 30), None]


def test_g5_anchor_date(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 10, 5, 6, 59, 59),),
                                (dt.datetime(2019, 10, 5, 7, 0, 0),)],
                               StructType([StructField("ts", TimestampNTZType())]))
    assert [r.a for r in df.select(anchor_date("ts").alias("a")).collect()] == ["20191004", "20191005"]


def test_csv_readers_pick_columns_by_header(spark, tmp_dir):
    from liqspark.sources.readers import read_bond_list, read_exchange_quotes, read_otc_quotes
    with open(f"{tmp_dir}/q.csv", "w") as f:
        f.write("extra,ask,bond,tg,date,bid\nz,101,1,20,2019-10-01,99\nz,,2,20,2019-10-01,98\n")
    ex = clean.clean_exchange_quotes(read_exchange_quotes(spark, f"{tmp_dir}/q.csv"))
    assert [(r.bond, r.bid, r.ask) for r in ex.collect()] == [(1, 99.0, 101.0)]
    with open(f"{tmp_dir}/o.csv", "w") as f:
        f.write("bond,org,date,quote_type,price\n1,5,2019-10-01,1,99\n1,5,2019-10-01,2,101\n")
    assert clean.pair_otc_quotes(read_otc_quotes(spark, f"{tmp_dir}/o.csv")).count() == 1
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write("id,isin_code,date_of_end_placing,maturity_date,usd_volume\n"
                "1,XS1,2010-01-01,2040-01-01 00:00:00,\n,XS2,,,\n")
    bl = clean.clean_bonds(read_bond_list(spark, f"{tmp_dir}/b.csv")).collect()
    assert [(r.id, r.isin, r.usd_volume) for r in bl] == [(1, "XS1", None)]
    assert bl[0].maturity_date == dt.datetime(2040, 1, 1)


def test_dated_paths():
    from liqspark.sources.paths import DatedPaths
    p = DatedPaths("20191005", "/in", "/out")
    assert p.exchange_quotes == "/in/quotes_20191005/quotes_20191005.csv"
    assert p.otc_quotes.endswith("quotes_mp_month_raw_20191005.csv")
    assert p.bond_list.endswith("bonds_20191005.csv")
    assert p.metrics_parquet == "/out/parquet_20191005"
    assert p.stream_checkpoint.startswith(p.stream_output)
    assert len(set(p.all().values())) == 6


def test_parsed_quotes_have_the_typed_schema(spark):
    from liqspark.functions.jsonq import parse_quote_json
    from liqspark.schemas import TYPED_QUOTE
    out = parse_quote_json(spark.createDataFrame([("{}",)], "value string"))
    assert [(f.name, f.dataType) for f in out.schema.fields] == \
        [(f.name, f.dataType) for f in TYPED_QUOTE.fields]
