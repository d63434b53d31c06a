"""Reads and writes that must not hide or lose anything."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from liqspark import session as S
from liqspark.operators import clean
from liqspark.plans import catalog, proxies as P, stream_job
from liqspark.sinks import upsert
from liqspark.sinks.upsert import read_upserted, upsert_latest, vacuum
from liqspark.sources.snapshot import read_snapshots, snapshot_explode, snapshot_rejects

SF = "/root/testdata/sf0.001"
QUOTE = "bond bigint, tg bigint, bid double, date date, update_ts timestamp"


def quotes(spark, rows):
    day = {None: None, 1: dt.date(2020, 1, 1), 2: dt.date(2020, 1, 2)}
    return spark.createDataFrame([(b, 1, bid, day[d], dt.datetime(2020, 1, 1, 0, t)) for b, bid, d, t in rows], QUOTE)


def table_rows(spark, path):
    return sorted((r.bond, r.bid, r.date is None) for r in read_upserted(spark, path).collect())


def test_upsert_keeps_rows_without_a_date(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    upsert_latest(quotes(spark, [(1, 1.0, None, 1), (2, 2.0, None, 1), (3, 3.0, 1, 1)]), path)
    upsert_latest(quotes(spark, [(2, 9.0, None, 2), (4, 4.0, 2, 1)]), path)
    assert table_rows(spark, path) == [(1, 1.0, True), (2, 9.0, True), (3, 3.0, False), (4, 4.0, False)]
    upsert_latest(quotes(spark, [(2, 9.0, None, 2), (4, 4.0, 2, 1)]), path)  # replayed
    assert len(table_rows(spark, path)) == 4


def test_upsert_refuses_a_damaged_table(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    upsert_latest(quotes(spark, [(i, 1.0, 1, 1) for i in range(50)]), path)
    for part in glob.glob(f"{path}/data/*/*/*.parquet"):
        with open(part, "wb") as f:
            f.write(b"not parquet")
    with pytest.raises(Exception):
        upsert_latest(quotes(spark, [(1, 2.0, 1, 2)]), path)


@pytest.mark.parametrize("at", ["write", "switch", "after"])
def test_upsert_survives_a_crash(spark, tmp_dir, monkeypatch, at):
    """The commit breaks off before its rows are written, with them written, or after the switch. Readers
    see the old table or the new one, the replay ends in the right one, stale folders go."""
    path = f"{tmp_dir}/t"
    first = quotes(spark, [(1, 1.0, None, 1), (2, 2.0, 1, 1), (3, 3.0, 2, 1)])
    second = quotes(spark, [(1, 0.5, None, 0), (2, 9.0, 1, 2), (4, 4.0, 1, 1)])
    upsert_latest(first, path)
    before = table_rows(spark, path)
    old_reader = read_upserted(spark, path)
    real_switch, real_merge, calls = upsert._switch, upsert.latest_quote, []

    def broken_switch(*args):
        if at == "after":
            real_switch(*args)
        raise RuntimeError("crash")

    def broken_merge(df, *args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("crash")
        return real_merge(df, *args)

    with monkeypatch.context() as m:
        m.setattr(upsert, "_switch", broken_switch) if at != "write" else m.setattr(upsert, "latest_quote", broken_merge)
        with pytest.raises(RuntimeError, match="crash"):
            upsert_latest(second, path)
    want = [(1, 1.0, True), (2, 9.0, False), (3, 3.0, False), (4, 4.0, False)]
    assert table_rows(spark, path) == (want if at == "after" else before)
    upsert_latest(second, path)
    assert table_rows(spark, path) == want
    assert sorted((r.bond, r.bid) for r in old_reader.collect()) == [(1, 1.0), (2, 2.0), (3, 3.0)]  # its folders are still there
    folders = set(glob.glob(f"{path}/data/*"))
    gone = vacuum(spark, path)
    assert table_rows(spark, path) == want and gone == len(folders) - len(glob.glob(f"{path}/data/*")) > 0 or at == "write"
    assert vacuum(spark, path) == 0


def test_two_writers_cannot_commit_one_version(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    upsert_latest(quotes(spark, [(1, 1.0, 1, 1)]), path)
    held = upsert._manifest(spark, path, 1)
    upsert._switch(spark, path, 2, held)
    with pytest.raises(RuntimeError, match="another writer"):
        upsert._switch(spark, path, 2, held)
    assert upsert.current_version(spark, path) == 2 and len(table_rows(spark, path)) == 1


def test_upserted_versions_and_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    with pytest.raises(FileNotFoundError):
        read_upserted(spark, path)
    upsert_latest(quotes(spark, [(1, 1.0, None, 1), (2, 2.0, 1, 1)]), path)
    upsert_latest(quotes(spark, [(1, 5.0, None, 2)]), path)
    upsert_latest(quotes(spark, []), path)  # an empty batch is no new version
    assert upsert.current_version(spark, path) == 2
    assert sorted(r.bid for r in read_upserted(spark, path, version=1).collect()) == [1.0, 2.0]
    assert [r.bid for r in read_upserted(spark, path, partitions=[None]).collect()] == [5.0]
    schema = read_upserted(spark, path).schema
    assert read_upserted(spark, path, schema, ["2031-01-01"]).count() == 0


def test_upsert_table_holds_the_newest_quote_of_the_stream(spark, tmp_dir):
    _, metrics = catalog._materialized_metrics(spark, SF)
    P.intraday_json(spark, SF).select("value").write.text(f"{tmp_dir}/landing")
    values = spark.readStream.format("text").load(f"{tmp_dir}/landing")
    q = stream_job.start(spark, values, metrics, f"{tmp_dir}/out", available_now=True, upsert_table=f"{tmp_dir}/table")
    q.awaitTermination()
    assert q.exception() is None
    got = read_upserted(spark, f"{tmp_dir}/table")
    events = P.table(spark, SF, "events")
    assert got.agg(F.max("update_ts").cast("timestamp_ntz")).first()[0] == events.agg(F.max("ts").cast("timestamp_ntz")).first()[0]
    assert got.count() == events.select("user_id", "event_type", F.to_date("ts")).distinct().count()


def test_damaged_metrics_fail_the_job(spark, tmp_dir):
    _, path = catalog._materialized_metrics(spark, SF)
    assert stream_job.read_metrics(spark, path).count() > 0
    with open(f"{tmp_dir}/x.parquet", "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        stream_job.read_metrics(spark, tmp_dir).count()
    with pytest.raises(ValueError):
        stream_job.read_metrics(spark, path, "orc")


def test_readback_ignores_files_that_were_not_committed(spark):
    from liqspark.streaming.runner import run_available_now
    out = S.scratch_dir(spark, "orphan")
    run_available_now(catalog._event_stream(spark, SF), out, f"{out}/_checkpoint")
    n = spark.read.parquet(out).count()
    spark.range(50).selectExpr("cast(id as string) as value").write.mode("append").parquet(f"{out}-other")
    import shutil
    target = out.removeprefix("file:")
    shutil.copy(glob.glob(f"{target}-other/*.parquet")[0], f"{target}/part-orphan.parquet")
    assert spark.read.parquet(out).count() == n
    S.remove_scratch(spark, out)
    assert not S.path_exists(spark, out)
    with pytest.raises(ValueError):
        S.remove_scratch(spark, "/tmp")


def test_whole_document_snapshots_and_rejects(spark, tmp_dir):
    texts = ['{"count": 1,\n "items": [\n {"emission_id": "5", "buying_quote": null}, 7, "x"\n]}', '{"count": 0, "items": []}',
             '{"items": [{"emission_id": "6"}]}', '{"count": 1, "items": {"a": 1}}', "not json"]
    for k, text in enumerate(texts):
        with open(f"{tmp_dir}/{k}.json", "w") as f:
            f.write(text)
    docs = read_snapshots(spark, tmp_dir, "documents")
    assert docs.count() == 5
    rows = snapshot_explode(docs).collect()
    assert [(r.bond, r.bid, r.ask, r.date) for r in rows] == [("5", None, "0", "1970-01-01")]
    assert sorted(r.value for r in snapshot_rejects(docs).collect()) == sorted(texts[2:])


def test_otc_contract_holds_before_the_join(spark):
    row = lambda b, side, p="10": (b, "1", "2020-01-01 00:00:00", side, p)
    raw = spark.createDataFrame([row("1", "1"), row("1", "2", "11"), row("abc", "1"), row("abc", "2"), row("2", "1", "0"), row(None, "1")],
                                "bond string, org string, date string, quote_type string, price string")
    assert clean.pair_otc_quotes(raw).count() == 1
    with pytest.raises(Exception, match="bad bond"):
        clean.pair_otc_quotes(raw, mode="assert").collect()
    assert clean.pair_otc_quotes(raw.where("bond = '1'"), mode="assert").count() == 1
    tagged = sorted((r.bond or 0, r.bid or 0, r.ask or 0, r._rejected_fields) for r in clean.pair_otc_quotes(raw, mode="quarantine").collect())
    assert tagged == [(0, 0, 10.0, ["bond"]), (0, 10.0, 0, ["bond"]), (1, 10.0, 11.0, [])]


def test_cluster_needs_a_shared_checkpoint_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S.checkpoint_root(Session())
