"""End-to-end batch and stream jobs over CSV / JSON-lines files made from the test tables."""

from pyspark.sql import functions as F

from liqspark.plans import batch_job, catalog, proxies as P, stream_job
from liqspark.sources.paths import DatedPaths

SF = "/root/testdata/sf0.001"


def _stage_day(spark, paths: DatedPaths):
    ex = P.exchange_quotes(spark, SF)
    ex.select(*[F.col(c).cast("string") for c in ex.columns]).write.option("header", True) \
        .mode("overwrite").csv(paths.exchange_quotes)
    P.otc_quotes(spark, SF).write.option("header", True).mode("overwrite").csv(paths.otc_quotes)
    P.bonds(spark, SF).write.option("header", True).mode("overwrite").csv(paths.bond_list)


def test_batch_job_end_to_end(spark, tmp_dir):
    paths = DatedPaths("20191005", f"{tmp_dir}/in", f"{tmp_dir}/out")
    _stage_day(spark, paths)
    stored = batch_job.run(spark, paths, otc_pairs=True,
                           excluded_grounds=P.PROXY_EXCLUDED_GROUNDS)
    expect = catalog.REGISTRY["liquidity_metrics"].fn(spark, SF)
    assert stored.exceptAll(expect).count() == 0 and expect.exceptAll(stored).count() == 0
    from liqspark.sinks.writers import read_metrics_csv
    csv = read_metrics_csv(spark, paths.metrics_csv)
    assert csv.exceptAll(expect).count() == 0
    pairs = spark.read.parquet(f"{paths.metrics_parquet}_otc_pairs")
    assert pairs.count() == catalog.REGISTRY["otc_pairing"].fn(spark, SF).count()


def test_anchor_for_now_is_a_date(spark):
    a = batch_job.anchor_for_now(spark)
    assert len(a) == 8 and a.isdigit()


def test_stream_job_available_now(spark, tmp_dir):
    metrics, mpath = catalog._materialized_metrics(spark, SF)
    landing = f"{tmp_dir}/landing"
    P.intraday_json(spark, SF).write.mode("overwrite").text(landing)
    values = spark.readStream.format("text").load(landing)
    out = f"{tmp_dir}/enriched"
    q = stream_job.start(spark, values, mpath, out, available_now=True)
    assert q.awaitTermination(600)
    got = spark.read.parquet(out)
    expect = catalog.REGISTRY["stream_enriched_quotes"].fn(spark, SF)
    got = got.withColumn("volume_money", F.round("volume_money", 6)) \
        .withColumn("update_ts", F.col("update_ts").cast("timestamp_ntz"))
    assert got.count() == expect.count()
    assert got.select(*expect.columns).exceptAll(expect).count() == 0
