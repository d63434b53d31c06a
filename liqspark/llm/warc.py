"""Not-modified revisit resolution for web capture records.

A revisit takes the latest full response of its canonical URL that was captured strictly
earlier (an as-of join), if its validators agree: the entity tag where the revisit has one,
else the last-modified date. Its headers are the response's, overlaid with those that a 304
reply may renew.

The as-of join is two bounded steps instead of one window over a URL: the latest response
inside the URL's time slot, and the latest of all earlier slots. A URL that holds a third of
all captures is spread over its slots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .url_filter import canonical_url

SLOTS = 4096
# Headers that a 304 reply may renew; those that describe the body stay with the response.
RENEWED = ("cache-control", "date", "expires", "vary")


def page_captures(pages: DataFrame) -> DataFrame:
    """Capture records that follow from ``pages``: every page is fetched in full and asked
    for again later; some replies carry another tag, no tag or come before any response.
    A time beyond the ends of bigint is null."""
    page, body = F.col("page_id"), F.md5(F.coalesce("html", F.lit("")))
    day = lambda x: F.concat(F.lit("day "), x.cast("string"))
    time = lambda later: F.try_add(F.try_multiply(page, F.lit(1000)), later)
    head = lambda **h: F.map_from_arrays(F.array(*[F.lit(k.replace("_", "-")) for k in h]), F.array(*h.values()))
    full = pages.select(
        F.concat(F.lit("f"), page.cast("string")).alias("record_id"), F.lit("response").alias("kind"), "url",
        time(F.lit(0)).alias("time"), body.alias("etag"), day(page % 9).alias("last_modified"),
        head(cache_control=F.lit("max-age=60"), content_length=F.length(F.coalesce("html", F.lit(""))).cast("string"),
             content_type=F.lit("text/html"), date=day(page)).alias("headers"), body.alias("digest"))
    lag = F.pmod(F.pmod(page, F.lit(9973)) * 7919, F.lit(9973)) + 1
    tag = F.when(page % 5 == 0, F.md5(F.concat_ws(":", F.lit("new"), page.cast("string")))).when(page % 7 != 0, body)
    again = pages.select(
        F.concat(F.lit("r"), page.cast("string")).alias("record_id"), F.lit("revisit").alias("kind"),
        F.concat(F.col("url"), F.when(F.col("url").contains("#"), "").otherwise("#again")).alias("url"),
        time(F.when(page % 11 == 0, F.lit(-500)).otherwise(lag * 50)).alias("time"), tag.alias("etag"),
        day(page % 9 + F.when(page % 35 == 14, 1).otherwise(0)).alias("last_modified"),
        head(content_type=F.lit("text/plain"), date=day(F.try_add(page, F.lit(1))), expires=day(F.try_add(page, F.lit(2)))).alias("headers"),
        F.lit(None).cast("string").alias("digest"))
    return full.unionByName(again)


def resolve_revisits(records: DataFrame, renewed=RENEWED, slots: int = SLOTS) -> DataFrame:
    """One row per revisit of ``records`` (record_id, kind, url, time, etag, last_modified,
    headers, digest): record_id, canonical, response_id, outcome, digest, headers.

    outcome is ``resolved``; ``changed`` if the latest earlier response has other validators,
    or the revisit has none; ``missing`` without an earlier response. Only the resolved have a
    digest and headers (``name: value`` lines by name). Of responses with the same URL and
    time the largest record_id counts. A null or unparsable URL, or a null time, matches
    nothing; null headers count as none; repeated revisits stay repeated. Other columns are
    ignored; an empty table gives an empty result.
    """
    events = records.select("record_id", "kind", F.nullif(canonical_url(F.col("url")), F.lit("")).alias("canonical"), "time",
                            "etag", "last_modified", "digest",
                            F.array_sort(F.map_entries(F.coalesce("headers", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))).alias("headers"))
    span = events.agg(F.min("time").alias("low"), F.max("time").alias("high"))
    # In doubles, which hold any span; times that become equal share a slot, so slots still rise with time.
    low, high = F.col("low").cast("double"), F.col("high").cast("double")
    width = F.greatest(F.lit(1.0), (high - low) / slots)
    events = (events.join(F.broadcast(span))  # one row
              .withColumn("slot", F.floor((F.col("time").cast("double") - low) / width)).drop("low", "high"))
    payload = F.when(F.col("kind") == "response", F.struct("time", "record_id", "etag", "last_modified", "digest", "headers"))
    usable = events.where("canonical is not null and time is not null").withColumn("response", payload)
    key = ["canonical", "slot"]
    last = usable.groupBy(*key).agg(F.max("response").alias("last"))
    earlier = Window.partitionBy("canonical").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*key, F.max("last").over(earlier).alias("carried"))
    # Places of times instead of times: the one before the least bigint is still a number.
    usable = usable.withColumn("place", F.dense_rank().over(Window.partitionBy(*key).orderBy("time")))
    inside = Window.partitionBy(*key).orderBy("place").rangeBetween(Window.unboundedPreceding, -1)
    asked = usable.withColumn("near", F.max("response").over(inside)).where("kind = 'revisit'")
    found = asked.join(carried, key).select(
        "record_id", "canonical", "etag", "last_modified", "headers", F.coalesce("near", "carried").alias("r"))
    lost = events.where("kind = 'revisit' and (canonical is null or time is null)").select(
        "record_id", "canonical", "etag", "last_modified", "headers", F.lit(None).cast(found.schema["r"].dataType).alias("r"))
    agree = F.when(F.col("etag").isNotNull(), F.col("etag") == F.col("r.etag")).otherwise(F.col("last_modified") == F.col("r.last_modified"))
    outcome = F.when(F.col("r").isNull(), "missing").when(F.coalesce(agree, F.lit(False)), "resolved").otherwise("changed")
    permitted = F.filter("headers", lambda h: F.lower(h["key"]).isin(*renewed))
    names = F.transform(permitted, lambda h: F.lower(h["key"]))
    kept = F.filter("r.headers", lambda h: ~F.array_contains(names, F.lower(h["key"])))
    merged = F.array_sort(F.transform(F.concat(kept, permitted), lambda h: F.concat_ws(": ", F.lower(h["key"]), h["value"])))
    out = found.unionByName(lost).withColumn("outcome", outcome)
    done = F.col("outcome") == "resolved"
    return out.select("record_id", "canonical", F.col("r.record_id").alias("response_id"), "outcome",
                      F.when(done, F.col("r.digest")).alias("digest"), F.when(done, F.array_join(merged, "\n")).alias("headers"))
