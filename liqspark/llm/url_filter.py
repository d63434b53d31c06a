"""URL filter: rules on host and path first, then a list of canonical URLs.

The list becomes a blocked Bloom filter: a table of 256-bit blocks, one block and eight bits
for each URL, built by ``bit_or`` per block. The number of blocks follows the length of the
list up to ``MAX_BLOCKS``, so the broadcast table has a fixed bound; a longer list only lets
more URLs through. What passes goes to an exact hash join with the list, which removes the
false positives, so the result is exact at any filter size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_URL = 16
MAX_BLOCKS = 1 << 18  # 8 MB of bits, some 40 MB as a broadcast table
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Query parameters that don't name a page.
TRACKING = r"(^|&)(utm_[^&=]*|ref|gclid|fbclid)=[^&]*"

# (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port, path without closing slashes or ``.html``, and
    the query without tracking parameters; empty without a host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "([.]html|/+)$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), "^&", "")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(host == "", F.lit("")).otherwise(whole)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as ``host/path``, and its verdict; null without one."""
    name = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _bits(canonical: Column, blocks: int) -> list[Column]:
    """The block of a URL, and its bits in the block's four words (two bits each)."""
    h = F.xxhash64(canonical, F.lit(1))
    words = []
    for k in range(4):
        one, two = (F.shiftrightunsigned(h, 12 * k + s).bitwiseAND(F.lit(63)).cast("int") for s in (0, 6))
        mask = [F.call_function("shiftleft", F.lit(1).cast("bigint"), b) for b in (one, two)]
        words.append(mask[0].bitwiseOR(mask[1]).alias(f"m{k}"))
    return [F.pmod(F.xxhash64(canonical), F.lit(blocks)).alias("block"), *words]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0, w1, w2, w3) of the canonical URLs in ``listed``; at most ``blocks`` rows."""
    return (listed.select(*_bits(F.col("canonical"), blocks)).groupBy("block")
            .agg(*[F.bit_or(f"m{k}").alias(f"w{k}") for k in range(4)]))


def url_filter(pages: DataFrame, listed: DataFrame, rules=RULES, url_col: str = "url",
               list_col: str = "url", keep=("page_id",), max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Judges every page: the ``keep`` columns, host, path, rule, verdict, canonical, maybe
    (passed the Bloom filter) and listed.

    A URL that no rule fits is blocked if its canonical form is listed, else allowed. A null
    URL, or one without ``://``, has an empty host, path and canonical form, and is never
    listed. Repeated pages are judged each; repeated or null list entries count once or not
    at all; other columns are dropped; an empty table gives an empty result.
    """
    names = listed.select(canonical_url(F.col(list_col)).alias("canonical")).where("canonical <> ''").distinct()
    blocks, wanted = 1, names.count() * BITS_PER_URL
    while blocks * 256 < wanted and blocks < max_blocks:
        blocks *= 2
    url = F.col(url_col)
    judged = pages.select(*keep, host_of(url).alias("host"), path_of(url).alias("path"), canonical_url(url).alias("canonical"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": rule, "by_rule": verdict})
    bits = _bits(F.col("canonical"), blocks)
    probe = judged.withColumns(dict(zip(["block", "m0", "m1", "m2", "m3"], bits)))
    hit = " AND ".join(f"coalesce(w{k} & m{k} = m{k}, false)" for k in range(4))
    probe = (probe.join(F.broadcast(bloom_blocks(names, blocks)), "block", "left")
             .withColumn("maybe", F.expr(f"canonical <> '' AND {hit}")))
    exact = probe.where("maybe").join(names.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "canonical", "left")
    rest = probe.where("not maybe").withColumn("listed", F.lit(False))
    out = exact.withColumn("listed", F.coalesce("listed", F.lit(False))).unionByName(rest)
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(*keep, "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "canonical", "maybe", "listed")
