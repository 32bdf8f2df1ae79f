"""Secret scan: credentials in texts, with SQL functions only.

Strong patterns report by themselves. Weak ones (a name, an opaque string, an
address) report only where complementary parts lie together: access
identifiers, secrets and endpoints of a document meet by an interval join
within their scope, the paragraph and ``reach`` code points around a secret.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import once, written

REACH = 240  # code points between complementary parts


def _either_case(words: str) -> str:
    """ASCII letters of a pattern in either case. Not the flag: for some engines it takes in letters beyond ASCII."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


_SET = r"""["']?\x20*[:=]\x20*["']?"""

# The base patterns, in the order in which spans of one start are listed.
ASSIGN = f"({_either_case('password|passwd|secret|token|api_?key')}){_SET}([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters or more
HEX = "[0-9a-f]{24,}"

NAMES = "access_?key_?id|access_?key|client_?id|key_?id|username|user|login|account"
VALUES = "secret_?key|private_?key|passphrase|password|passwd|secret|token|api_?key|pass|pwd|credential"
PLACES = "hostname|host|endpoint|server|base_?url"
IDENTIFIER = f"(?:{_either_case(NAMES)}){_SET}[A-Za-z0-9@._+-]{{3,}}|AKIA[A-Z0-9]{{8,}}|ASIA[A-Z0-9]{{8,}}|[A-Za-z0-9._%+-]{{1,64}}@[A-Za-z0-9-]{{1,63}}[.][A-Za-z0-9.-]{{2,}}"
SECRET = f"(?:{_either_case(VALUES)}){_SET}[A-Za-z0-9+/_.=-]{{4,}}|[A-Za-z0-9+/_-]{{20,}}"
ENDPOINT = (r"(?:https|http|ftp|ssh|s3|mysql|postgresql|postgres|mongodb|redis|amqp)://[^\x20\x09-\x0D\"'<>]+"
            f"|(?:{_either_case(PLACES)}){_SET}[A-Za-z0-9._:/-]{{3,}}")
OPAQUE = "[A-Za-z0-9+/_-]{20,}"
BREAK = r"\n[\x20\t\r]*\n"

# kind: (pattern, strong, role)
KINDS = {
    "assign": (ASSIGN, True, "secret"),
    "access": (ACCESS, True, "identifier"),
    "hex": (HEX, True, "secret"),
    "identifier": (IDENTIFIER, False, "identifier"),
    "secret": (SECRET, False, "secret"),
    "endpoint": (ENDPOINT, False, "endpoint"),
}
_KEY = ["doc", "digest"]


SPANS = "array<struct<kind:string,start:bigint,end:bigint,strong:boolean,value:string>>"


def _kept() -> Column:
    """Of the matches: long enough values, and opaque strings that mix digits, capitals and small letters."""
    value = F.col("value")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")
    return (
        F.when(F.col("kind") == "assign", F.length(F.regexp_extract(value, ASSIGN, 2)) >= 6)
        .when(F.col("kind") == "secret", ~value.rlike(f"^{OPAQUE}$") | mixed)
        .otherwise(F.lit(True))
    )


def _per_kind(of) -> Column:
    """``of(pattern)`` of the row's kind."""
    chain = F
    for kind, (pattern, _, _) in KINDS.items():
        chain = chain.when(F.col("kind") == kind, of(pattern))
    return chain


def _matches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row per match of any pattern: its document, kind, value, and the length
    and paragraph ends of what lies between it and the match before. Weak
    patterns are only tried where a secret of some kind was found."""

    def found(kind: str) -> Column:
        return F.regexp_extract_all("text", F.lit(KINDS[kind][0]), 0)

    def among(*kinds: str) -> Column:
        return reduce(lambda a, b: a | b, [F.size(k) > 0 for k in kinds])

    none = F.array().cast("array<string>")
    row = docs.filter(F.length(text) > 0).select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    row = row.withColumn("b", once(F.struct(*[found(k).alias(k) for k in ("assign", "access", "hex", "secret")]))).select("doc", "text", "b.*")
    some = among("assign", "hex", "secret", "access")
    row = row.filter(some).withColumn("w", once(F.struct(*[found(k).alias(k) for k in ("identifier", "endpoint")]))).select(*row.columns, "w.*")
    row = row.filter(among("assign", "access", "hex", "identifier", "endpoint"))  # weak secrets alone are none
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("found")) for k in KINDS])
    row = row.select("doc", F.md5("text").alias("digest"), "text", F.explode(each).alias("k")).select("doc", "digest", "text", "k.*")
    row = row.filter(F.size("found") > 0).withColumn("between", once(_per_kind(lambda p: F.split("text", p, -1))))
    row = row.select("doc", "digest", "kind", F.posexplode(F.arrays_zip("found", "between")).alias("number", "m"))
    return row.filter("m.found IS NOT NULL").select(  # what follows the last match has none
        "doc", "digest", "kind", "number", F.col("m.found").alias("value"), F.length("m.between").cast("bigint").alias("gap"),
        (F.size(F.split("m.between", BREAK, -1)) - 1).alias("breaks"))


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of all patterns with their place and paragraph. A weak span inside
    a strong one says nothing new and is left out. Rows that repeat a document count once."""
    found = _matches(docs, key, text).distinct()
    before = Window.partitionBy(*_KEY, "kind").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("value").cast("bigint")
    placed = found.withColumn("end", F.sum(F.col("gap") + size).over(before)).withColumn("scope", F.sum("breaks").over(before))
    strong = F.col("kind").isin([k for k, (_, strong, _) in KINDS.items() if strong])
    placed = placed.filter(_kept()).select(
        *_KEY, "kind", (F.col("end") - size).alias("start"), "end", "value", "scope", strong.alias("strong"), _per_kind_role().alias("role"))
    so_far = Window.partitionBy(*_KEY).orderBy("start", F.desc("strong"), F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    covered = F.max(F.when(F.col("strong"), F.col("end"))).over(so_far)
    return placed.withColumn("covered", covered).filter(F.col("strong") | F.col("covered").isNull() | (F.col("covered") < F.col("end"))).drop("covered")


def _per_kind_role() -> Column:
    chain = F
    for kind, (_, _, role) in KINDS.items():
        chain = chain.when(F.col("kind") == kind, F.lit(role))
    return chain


def links(found: DataFrame, reach: int = REACH) -> DataFrame:
    """Pairs (``a``, ``b``) of a secret and an identifier or endpoint of its
    document and paragraph, at most ``reach`` code points apart, one of them
    weak. Spans meet in bins of ``reach`` code points; a pair counts in the first
    bin that both are in. Spans of one kind do not overlap, so the partners of
    a span are bounded by its length and ``reach``, however long the document."""
    wide = F.lit(reach).cast("bigint")

    def side(rows: DataFrame, name: str, margin: Column) -> DataFrame:
        low = F.call_function("div", F.greatest(F.col("start") - margin, F.lit(0).cast("bigint")), wide)
        high = F.call_function("div", F.col("end") - 1 + margin, wide)
        span = F.struct("kind", "start", "end", "value", "strong")
        return rows.select(*[F.col(c).alias(f"{name}_{c}") for c in (*_KEY, "scope")], span.alias(name), low.alias(f"{name}_low"), F.explode(F.sequence(low, high)).alias(f"{name}_bin"))

    a = side(found.filter("role = 'secret'"), "a", wide)
    b = side(found.filter("role <> 'secret'"), "b", F.lit(0).cast("bigint"))
    apart = F.greatest(F.col("b.start") - F.col("a.end"), F.col("a.start") - F.col("b.end"))
    met = a.join(
        b, F.col("a_doc").eqNullSafe(F.col("b_doc")) & (F.col("a_digest") == F.col("b_digest")) & (F.col("a_scope") == F.col("b_scope"))
        & (F.col("a_bin") == F.col("b_bin")) & (F.col("a_bin") == F.greatest("a_low", "b_low"))
        & (apart <= reach) & ~(F.col("a.strong") & F.col("b.strong")))
    return met.select(F.col("a_doc").alias("doc"), F.col("a_digest").alias("digest"), "a", "b")


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row per row of ``docs``: ``key`` and ``spans``, its credentials by
    start, kind and end: ``kind, start, end`` (code points, end exclusive),
    ``strong`` and the matched ``value``.

    Strong kinds are ``assign``, ``access`` and ``hex``; ``identifier``,
    ``secret`` and ``endpoint`` are weak and only listed with a partner (see
    ``links``). Null and empty texts and texts without any have an empty list.
    Rows that repeat a key are judged by their own texts, equal rows alike; null
    keys are allowed. An empty table gives an empty result. Very long texts cost
    in proportion to their length. Other columns, whatever their names, are
    left alone. Texts are not shuffled, only matches are.
    """
    found = written(candidates(docs, key, text), "credential-parts")
    met = links(found, reach)
    ends = [met.filter(~F.col(f"{n}.strong")).select(*_KEY, f"{n}.*") for n in ("a", "b")]
    spans = found.filter("strong").select(*_KEY, "kind", "start", "end", "value", "strong").unionByName(ends[0].unionByName(ends[1]).distinct())
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    listed = spans.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("start", order.alias("order"), "end", "kind", "strong", "value"))).alias("s"))
    listed = listed.select(
        F.col("doc").alias("s_doc"), "digest",
        F.transform("s", lambda s: F.struct(s["kind"], s["start"], s["end"], s["strong"], s["value"])).cast(SPANS).alias("spans"))
    rows = docs.select(F.col(key).alias("doc"), F.md5(F.col(text).cast("string")).alias("own"))
    joined = rows.join(listed, F.col("doc").eqNullSafe(F.col("s_doc")) & (F.col("own") == F.col("digest")), "left")
    return joined.select(F.col("doc").alias(key), F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def span_list(spans: Column, strong_only: bool = False) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    some = F.filter(spans, lambda s: s["strong"]) if strong_only else spans
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
