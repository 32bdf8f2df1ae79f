"""Substring dedup by hashing normalised lines or paragraphs."""

from __future__ import annotations

import re
from hashlib import md5

from pyspark.sql import DataFrame, functions as F

from .common import map_texts, written

SEPARATORS = {"line": "\n", "paragraph": "\n\n"}
_SPACE = re.compile("[ \t\x0b\f\r\n]+")
_UNIT = "doc_id bigint, unit int, start bigint, length bigint, n_words int, digest binary"


def normal_form(unit: str) -> str:
    """Lower case, ASCII white space runs as one space, none at the ends."""
    return _SPACE.sub(" ", unit.lower()).strip(" ")


def units(docs: DataFrame, unit: str = "line", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per non-empty unit of every text: its number, its place in the
    text in characters from 0, its words and the digest of its normal form."""
    separator = SEPARATORS[unit]

    def rows(pairs):
        for doc, text in pairs:
            at = 0
            for number, piece in enumerate((text or "").split(separator)):
                normal = normal_form(piece)
                if normal:
                    yield doc, number, at, len(piece), normal.count(" ") + 1, md5(normal.encode("utf-8", "replace")).digest()
                at += len(piece) + len(separator)

    return map_texts(docs, rows, _UNIT, id_col, text_col)


def repeated_units(docs: DataFrame, unit: str = "line", min_words: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The units to remove: every occurrence but the earliest of each normal form.

    Columns ``doc_id, unit, start, length, first_doc_id, first_unit``: offsets
    are those of the original text, ``first_*`` names the occurrence kept. The
    earliest is the least (doc_id, unit, start); a null doc_id ranks last. All
    units that are not blank count; with ``min_words`` shorter ones may stay (a
    text without spaces is one word).
    Rows repeated with the same doc_id rank by their offsets and, where all is
    equal, count as one occurrence, so both stay. Null and empty texts have no
    units. First occurrences combine before the shuffle and are written; the join
    back to a hot digest is one that AQE splits.
    """
    found = units(docs, unit, id_col, text_col).filter(F.col("n_words") >= min_words)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "unit", "start")
    first = (
        found.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("latest"))
        .filter("first < latest").select("digest", "first")
    )
    first = written(first, "first-units")  # read back, it has no partitioning the join would keep: AQE may split a hot digest
    return found.join(first, "digest").filter(rank > F.col("first")).select(
        "doc_id", "unit", "start", "length",
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.unit").alias("first_unit"),
    )


def without_units(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed units' characters taken out of the text (the
    separators stay)."""
    spans = removed.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("_spans"))
    cut = F.concat(
        F.substring(text_col, F.lit(1), F.get("_spans", F.lit(0))["start"].cast("int")),
        F.array_join(F.transform("_spans", lambda s, i: F.substring(
            F.col(text_col), (s["start"] + s["length"] + 1).cast("int"),
            (F.coalesce(F.get("_spans", i + 1)["start"], F.length(text_col).cast("bigint")) - s["start"] - s["length"]).cast("int"),
        )), ""),
    )
    joined = docs.join(spans, docs[id_col] == spans["doc_id"], "left").drop(spans["doc_id"])
    return joined.withColumn(text_col, F.when(F.col("_spans").isNull(), F.col(text_col)).otherwise(cut)).drop("_spans")
