"""One registered query per operator, with its DuckDB twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from public_tokenizers import path

from . import decontamination, embeddings, filter_audit, language, licences, line_dedup, merkle, packing
from . import secrets, simhash, suffix_dedup, token_files, url_filter
from ..session import scratch
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, twin: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if twin is not None:
            ORACLES[name] = twin
        return function

    return register


# The rules judged by op4: (host, path, verdict).
URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]
_OP4 = """
WITH rest AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
                       ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
raw AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
parts AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM raw),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                          ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, h || p AS rule, v,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h || p) DESC, v DESC) AS n
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT parts.page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE n = 1) f ON f.page_id = parts.page_id
"""


@query("op4_url_filter", _OP4)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


_OP5 = r"""
WITH pieces AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
placed AS (
  SELECT doc_id, i - 1 AS unit, p[i] AS piece FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM pieces)),
starts AS (
  SELECT *, CAST(coalesce(sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY unit
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
         trim(regexp_replace(lower(piece), '[ \t\x0b\f\r\n]+', ' ', 'g')) AS normal FROM placed),
ranked AS (
  SELECT doc_id, CAST(unit AS INTEGER) AS unit, start, CAST(length(piece) AS BIGINT) AS length,
         first_value(doc_id) OVER w AS first_doc_id, CAST(first_value(unit) OVER w AS INTEGER) AS first_unit,
         row_number() OVER w AS n
  FROM starts WHERE normal <> ''
  WINDOW w AS (PARTITION BY md5(normal) ORDER BY doc_id, unit))
SELECT doc_id, unit, start, length, first_doc_id, first_unit FROM ranked WHERE n > 1
"""


@query("op5_line_dedup", _OP5)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_units(table(spark, sf_dir, "documents"))


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical_sql(column: str) -> str:
    """The twin of ``licences.canonical``; SQL has no look-ahead, so lines of
    terms that open with "copyright notice" and the like are guarded by a mark."""
    plain = f"lower({column})"
    for word in ("notice", "holder", "owner"):
        plain = f"replace({plain}, 'copyright {word}', 'copyrigh{chr(1)}t {word}')"
    plain = f"regexp_replace({plain}, '(^|\\n)[ \\t]*(copyright |copyright\\n|\\(c\\)|©|all rights reserved)[^\\n]*', '\\1', 'g')"
    plain = f"replace({plain}, chr(1), '')"
    plain = f"' ' || trim(regexp_replace({plain}, '[^\\pL\\pN]+', ' ', 'g')) || ' '"
    for spelling, same in licences.EQUIVALENT.items():
        plain = f"replace({plain}, ' {spelling} ', ' {same} ')"
    return f"trim({plain})"


_OP6 = f"""
WITH known(licence, text) AS (VALUES {', '.join(f'({_text(i)}, {_text(t)})' for i, t in licences.KNOWN)}),
digests AS (SELECT sha256({_canonical_sql('text')}) AS digest, min(licence) AS licence FROM known GROUP BY 1),
pieces AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents),
texts AS (
  SELECT doc_id, 'text' AS scope, CAST(NULL AS INTEGER) AS line, text FROM documents
  UNION ALL
  SELECT doc_id, 'line', CAST(i - 1 AS INTEGER), p[i] FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM pieces)),
plain AS (SELECT doc_id, scope, line, {_canonical_sql('text')} AS plain FROM texts)
SELECT doc_id, scope, line, licence FROM plain JOIN digests ON sha256(plain) = digest WHERE plain <> ''
"""


@query("op6_licence_scan", _OP6)
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


@query("op1_pack")
def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), end_id=0, room=2048,
        derive={"ids_crc32": F.crc32("ids")},
    )


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(~language.held_out()))
    predicted = language.predict(docs, model)
    return predicted.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query("op7_simhash_near_dup")
def op7_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, words=1, radius=2)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, path("word_bpe_49k.json"), "word", end_id=2)
    found = token_files.read_token_files(spark, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op10_embedding_near_dup")
def op10_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


@query("op8_decontaminate")
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    length = F.aggregate("removed", F.lit(0).cast("bigint"), lambda acc, r: acc + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_bytes", length.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


_CRC_IS_EVEN = """list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
       lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
     lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END) & 1 = 1"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(v) for v in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _tree(name: str, leaves: str) -> str:
    """All nodes above ``leaves`` (g, size, i, h) and, for each leaf, its way up:
    siblings left and right of it and of its ancestors."""
    return f"""
{name}_up AS (
  SELECT g, size, 0 AS level, i, h FROM {leaves}
  UNION ALL
  SELECT g, size, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)) FROM {name}_up
  WHERE size > pow(3, level) GROUP BY g, size, level, i // 3),
{name}_steps AS (
  SELECT a.g, a.i, c.level,
         coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i < c.i), '') AS l,
         coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i > c.i), '') AS r
  FROM {leaves} a JOIN {name}_up c ON c.g IS NOT DISTINCT FROM a.g AND c.i = a.i // CAST(pow(3, c.level) AS BIGINT) AND c.size > pow(3, c.level)
  JOIN {name}_up s ON s.g IS NOT DISTINCT FROM c.g AND s.level = c.level AND s.i // 3 = c.i // 3
  GROUP BY a.g, a.i, c.level, c.i),
{name}_paths AS (SELECT g, i, list({{'l': l, 'r': r}} ORDER BY level) AS path FROM {name}_steps GROUP BY g, i),
{name}_roots AS (SELECT g, size, h FROM {name}_up WHERE size <= pow(3, level) QUALIFY row_number() OVER (PARTITION BY g ORDER BY level) = 1)"""


_OP12 = f"""
WITH RECURSIVE digests AS (
  SELECT doc_id, source, {_leaf('text')} AS h, CASE WHEN {_CRC_IS_EVEN} THEN {_leaf("replace(text, chr(10), '')")} END AS tampered FROM documents),
leaves AS (
  SELECT doc_id, source AS g, h, tampered, count(*) OVER (PARTITION BY source) AS size,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM digests),
{_tree('low', 'leaves')},
sources AS (SELECT 0 AS g, g AS source, h, count(*) OVER () AS size, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS i FROM low_roots),
{_tree('high', 'sources')},
whole AS (
  SELECT a.doc_id, a.h AS leaf, a.tampered, s.h AS subroot, (SELECT h FROM high_roots) AS root,
         list_concat(coalesce(p.path, []), coalesce(q.path, [])) AS path
  FROM leaves a JOIN sources s ON s.source IS NOT DISTINCT FROM a.g
  LEFT JOIN low_paths p ON p.g IS NOT DISTINCT FROM a.g AND p.i = a.i LEFT JOIN high_paths q ON q.i = s.i),
folded AS (
  SELECT *, list_reduce(list_concat([{{'l': coalesce(tampered, leaf), 'r': ''}}], path),
                        lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM folded
"""


@query("op12_merkle_manifest", _OP12)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = merkle.leaf_digest(*[F.translate(c, "\n", "") if c == "text" else F.col(c) for c in columns])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.unhex(tampered))
    found = merkle.manifest(table(spark, sf_dir, "documents"), columns, "source", "doc_id", carry={"tampered": tampered})
    found = found.withColumn("folded_root", merkle.fold(F.coalesce(F.lower(F.hex("tampered")), "leaf"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_OP13 = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marked AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS bad FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
         [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
          regexp_matches(text, '[#$%&*|]'),
          coalesce(words.doc_id > min(words.doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM words LEFT JOIN marked ON marked.doc_id = words.doc_id),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS f),
orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
cells AS (SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(bad) AS bad FROM judged GROUP BY part, fails),
steps AS (
  SELECT part, o, s.step, n, good, bad,
         fails[o[s.step]] AS fails_own,
         len(list_filter(o[1:s.step - 1], lambda f: fails[f])) > 0 AS gone,
         len(list_filter(fails, lambda x: x)) = 1 AS one
  FROM cells, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
sums AS (
  SELECT part, o, step, sum(n) FILTER (NOT gone AND NOT fails_own) AS kept, sum(n) FILTER (NOT gone AND fails_own) AS removed,
         sum(n) FILTER (gone AND fails_own) AS redundant, sum(n) FILTER (one AND fails_own) AS unique_fails,
         sum(good) FILTER (NOT gone AND fails_own) AS good_lost, sum(bad) FILTER (NOT gone AND fails_own) AS toxic_lost
  FROM steps GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda f: substr('ABCDE', f, 1)), '') AS filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, o[step]), 0) AS BIGINT) AS shapley
FROM sums
"""


@query("op13_filter_audit", _OP13)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _kind_sql(kind: str) -> str:
    pattern, strong, role = secrets.KINDS[kind]
    p = _text(pattern)
    keep = {
        "assign": f"length(regexp_extract(v, {p}, 2)) >= 6",
        "secret": f"NOT regexp_full_match(v, {_text(secrets.OPAQUE)}) OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]'))",
    }.get(kind, "true")
    return f"""
  SELECT n, {list(secrets.KINDS).index(kind)} AS k, '{kind}' AS kind, {strong} AS strong, '{role}' AS role, s, e, b AS scope FROM (
    SELECT n, v, sum(length(g) + length(v)) OVER w AS e, sum(length(g) + length(v)) OVER w - length(v) AS s,
           sum(len(string_split_regex(g, {_text(secrets.BREAK)})) - 1) OVER w AS b FROM (
      SELECT n, unnest(m) AS v, unnest(g[1:len(m)]) AS g, generate_subscripts(m, 1) AS i FROM (
        SELECT n, regexp_extract_all(text, {p}) AS m, string_split_regex(text, {p}) AS g FROM texts))
    WINDOW w AS (PARTITION BY n ORDER BY i ROWS UNBOUNDED PRECEDING))
  WHERE {keep}"""


_OP11 = f"""
WITH texts AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({' UNION ALL '.join(_kind_sql(k) for k in secrets.KINDS)}),
apart AS (
  SELECT * FROM parts p WHERE strong OR NOT EXISTS (
    SELECT 1 FROM parts q WHERE q.n = p.n AND q.strong AND q.s <= p.s AND q.e >= p.e)),
pairs AS (
  SELECT a.n, a.k, a.s, b.k AS bk, b.s AS bs FROM apart a JOIN apart b ON a.n = b.n AND a.scope = b.scope
  AND a.role = 'secret' AND b.role <> 'secret' AND greatest(b.s - a.e, a.s - b.e) <= {secrets.REACH} AND NOT (a.strong AND b.strong)),
shown AS (
  SELECT * FROM apart p WHERE strong
     OR EXISTS (SELECT 1 FROM pairs x WHERE x.n = p.n AND ((x.k = p.k AND x.s = p.s) OR (x.bk = p.k AND x.bs = p.s)))),
lists AS (
  SELECT n, count_if(kind = 'assign') AS n_assign, count_if(kind = 'access') AS n_access, count_if(kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (strong) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans FROM shown GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN lists ON lists.n = texts.n
"""


@query("op11_secret_scan", _OP11)
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.span_list(F.col("spans"), strong_only=True), 256).alias("base_sha256"),
        secrets.span_list(F.col("spans")).alias("spans"))
