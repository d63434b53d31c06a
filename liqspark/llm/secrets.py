"""Secret scan with multipart credential linking, in DataFrame functions only.

Base kinds are reported wherever they stand. Weak candidates (short assigned values, short
access identifiers) are reported only when a complementary part lies within ``SCOPE`` code
points of them in the same document: an identifier or an endpoint for a secret, a secret for
an identifier. The parts meet by an interval join: both sides are dealt to cells of the
document, joined on (document, cell), and compared by distance.

Positions come from the pieces between matches, exploded and summed per document and kind,
so a document with very many matches costs rows, not growing arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .running import join_same
from .tables import stored, text_of, whole_row

SCOPE = 200

# Fixed patterns of the base kinds, in the order in which they are listed. A match that is
# too short uses up its text all the same, so lengths are looked at afterwards; runs of hex
# digits hold no second match, so their least length is in the pattern.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
# Least length of a base secret and of a weak candidate, by the kind they come from.
LEAST = {"assign": (12, 6), "access": (18, 10)}

# Further parts: name, pattern. No pattern repeats a group, or looks far ahead at every place.
PARTS = (
    ("user", r"""(?i:user_?name|user|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]+"""),
    ("mail", r"[A-Za-z0-9._+-]{1,64}@[A-Za-z0-9-]+[.][A-Za-z0-9.-]+"),
    ("endpoint", r"(?:https?|jdbc|postgres|mysql|mongodb|redis|amqp|ftp)://[^\x20\x09-\x0D\"'<>]+"),
    ("address", r"[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}"),
)
KINDS = ("assign", "access", "hex", "weak_assign", "weak_access", *(name for name, _ in PARTS))
BASE = KINDS[:3]
IDENTIFIERS, SECRETS, ENDPOINTS = ("access", "weak_access", "user", "mail"), ("assign", "hex", "weak_assign"), ("endpoint", "address")
WEAK = ("weak_assign", "weak_access")


def _pieces(pattern: str, group: int = 0):
    """Array of (gap, size, value): code points before each match, in it and in its group."""
    text = F.col("text")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("m"), values.alias("v"))
    whole = F.transform(zipped, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["m"]).alias("size"), F.length(x["v"]).alias("value")))
    none = F.array().cast("array<struct<gap:int,size:int,value:int>>")
    return F.when(text.rlike(pattern), F.filter(whole, lambda x: x["size"].isNotNull())).otherwise(none)


def find_parts(docs: DataFrame, key: list[str]) -> DataFrame:
    """``key``, kind, start, end of every part in ``docs`` (``key``, text). Rows that share the
    key share their text, and their parts are listed once: repeated, they would be summed twice."""
    wanted = [("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), *((n, p, 0) for n, p in PARTS)]
    arrays = stored(docs.select(*key, *[_pieces(p, g).alias(n) for n, p, g in wanted])
                    .where(" OR ".join(f"size({n}) > 0" for n, _, _ in wanted)).dropDuplicates(key), "parts")
    rows = None
    for name, _, _ in wanted:
        one = arrays.where(f"size({name}) > 0").select(*key, F.lit(name).alias("kind"), F.posexplode(name).alias("pos", "x"))
        rows = one if rows is None else rows.unionByName(one)
    upto = Window.partitionBy(*key, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.expr("x.gap + x.size")).over(upto)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("x.size"))
    kind = F.col("kind")
    for name, (base, weak) in LEAST.items():
        kind = F.when((F.col("kind") == name) & (F.col("x.value") < weak), None).when(
            (F.col("kind") == name) & (F.col("x.value") < base), f"weak_{name}").otherwise(kind)
    return rows.select(*key, kind.alias("kind"), "start", "end").where("kind is not null")


def link_parts(parts: DataFrame, key: list[str], scope: int = SCOPE) -> DataFrame:
    """The weak parts that a complementary part stands by, by the interval join."""
    cells = lambda a, b: F.explode(F.sequence(F.floor(a / scope), F.floor(b / scope)))
    weak = parts.where(F.col("kind").isin(*WEAK)).withColumn("cell", cells(F.col("start") - scope, F.col("end") + scope))
    other = parts.select(*key, F.col("kind").alias("other"), F.col("start").alias("from"), F.col("end").alias("to"))
    other = other.withColumn("cell", cells(F.col("from"), F.col("to")))
    near = (F.col("from") <= F.col("end") + scope) & (F.col("to") >= F.col("start") - scope)
    fits = (((F.col("kind") == "weak_assign") & F.col("other").isin(*IDENTIFIERS, *ENDPOINTS))
            | ((F.col("kind") == "weak_access") & F.col("other").isin(*SECRETS)))
    return join_same(weak, other, [*key, "cell"], "left_semi", near & fits).select(*key, "kind", "start", "end").distinct()


def find_secrets(docs: DataFrame, key: list[str], scope: int = SCOPE) -> DataFrame:
    """``key``, kind, start, end of the base secrets and the linked weak ones."""
    parts = stored(find_parts(docs, key), "spans")
    return parts.where(F.col("kind").isin(*BASE)).unionByName(link_parts(parts, key, scope))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    A null text counts as empty. Repeated rows and rows that share an id are told apart by
    their texts and each get their own spans; a null id is kept. Spans that start together
    stand in the order of the kinds. Other columns are ignored; an empty table gives an empty
    result; texts of any length are searched whole.
    """
    key = ["doc_id", "text_id"]
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(docs, text_col).alias("text")).withColumn("text_id", F.xxhash64("text"))
    found = find_secrets(source, key, scope)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    found = found.withColumn("span", F.struct("start", rank.alias("rank"), F.concat_ws(":", "kind", "start", "end").alias("name")))
    listed = lambda keep: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(keep, F.col("span")))), lambda x: x["name"]), ",")
    base = F.col("kind").isin(*BASE)
    grouped = found.groupBy(*key).agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE],
        listed(base).alias("base"), listed(F.lit(True)).alias("spans"), F.count(F.when(~base, 1)).alias("n_linked"))
    out = join_same(source.select(*key), grouped, key, "left")
    n = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return out.select("doc_id", *[n(f"n_{k}") for k in BASE], F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"), n("n_linked"))


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]",
                   scope: int = SCOPE) -> DataFrame:
    """``docs`` with every span of its text replaced by ``mask`` (spans that overlap by one).
    Rows without a span, null texts and all other columns stay as they are."""
    key = ["doc_id", "text_id"]
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(docs, text_col)).alias("text_id"), whole_row(docs))
    text = F.col("carried")[text_col]
    found = find_secrets(keyed.select(*key, F.coalesce(text, F.lit("")).alias("text")), key, scope)
    spans = found.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = join_same(keyed, spans, key, "left")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    piece = lambda at, to: F.substr(text, (at + 1).cast("int"), (to - at).cast("int"))

    def step(held, span):
        cut = F.array(F.concat(piece(held["at"], span["start"]), F.lit(mask)))
        fresh = span["start"] >= held["at"]
        return F.struct(F.greatest(held["at"], span["end"]).alias("at"),
                        F.when(fresh, F.concat(held["out"], cut)).otherwise(held["out"]).alias("out"))

    done = F.aggregate("spans", start, step, lambda x: F.concat(F.array_join(x["out"], ""), piece(x["at"], F.length(text).cast("bigint"))))
    return joined.select(*[F.when(F.col("spans").isNotNull(), done).otherwise(text).alias(c) if c == text_col else F.col("carried")[c].alias(c)
                           for c in docs.columns])
