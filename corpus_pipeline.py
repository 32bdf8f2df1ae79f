"""The corpus pipeline: language, near copies, repeated passages, benchmark leaks,
packing. Every stage takes the documents its predecessor kept."""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.llm import decontamination, language, packing, simhash, suffix_dedup
from tillstream.llm.common import table, written

LEAST_SCORE = 0.5   # share of the best language in the likelihoods
SIMILARITY = 0.8    # of the sets of five-word shingles of near copies
NEAR_BITS = 56      # of 256; texts of that similarity differ in 39 on average, in more than 56 once in 500
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Texts that are null or without a
    letter go, and those no language fits better than all others together. Rows
    are judged one by one, whatever their ids; long texts are read whole; an
    empty table, or one without any labelled row, gives an empty result."""
    model = language.fit(docs)
    judged = language.with_language(docs.select(COLUMNS), model)
    return judged.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies: SimHash over five-word
    shingles, 256 bits, at most NEAR_BITS of them different, searched in 19
    tables of 13 bits and verified on the shingles; what the tables miss is found
    by the rare shingles that similar texts must share. Null, empty and blank
    texts are copies of each other. Rows without a doc_id stay. Rows that repeat
    one are one document, which stays or goes as a whole: equal texts of it stay
    once, different ones all. An empty table stays empty; long texts are
    compared whole; further columns are dropped before anything is joined."""
    found = simhash.near_duplicates(docs, shingle=5, words=4, radius=NEAR_BITS,
                                    tables=simhash.band_keys(256, 13), similarity=SIMILARITY)
    copies = written(found.filter("component_id <> doc_id").select("doc_id").distinct(), "near-copies")
    kept = docs.select(COLUMNS).join(copies, "doc_id", "left_anti")
    named = docs.filter("doc_id IS NOT NULL")
    if named.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        kept = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]).unionByName(kept.filter("doc_id IS NULL"))
    return kept.select(COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that begin earlier in the corpus, cut at
    whole characters; a text of which nothing is left goes. Null and empty texts
    stay, as empty ones; rows without a doc_id stay as they are. Rows that repeat a doc_id stay as many, each
    with the text cut from its own; those of one length share ``lang`` and
    ``source``. An empty table stays empty; long texts are cut like others;
    further columns are dropped before anything is joined."""
    named = docs.filter("doc_id IS NOT NULL")
    kept = suffix_dedup.dedup(named.select("doc_id", "text"), as_text=True).select("doc_id", "n_bytes", F.col("kept").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    rest = named.select("doc_id", size, "lang", "source").groupBy("doc_id", "n_bytes").agg(
        F.min(F.struct("lang", "source")).alias("_rest")).select("doc_id", "n_bytes", "_rest.*")
    cut = kept.join(rest, ["doc_id", "n_bytes"]).filter("n_bytes = 0 OR length(text) > 0")
    cut = cut.withColumn("n_chars", F.length("text").cast("bigint"))
    return cut.select(COLUMNS).unionByName(docs.filter("doc_id IS NULL").select(COLUMNS))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; of
    rows that repeat a doc_id all go if one of them does. Empty tables, of
    documents or of items, take nothing away; long texts are searched whole."""
    leaks = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))
    leaks = written(leaks.select("doc_id").distinct(), "leaks")
    kept = docs.select(COLUMNS).join(leaks, docs["doc_id"].eqNullSafe(leaks["doc_id"]), "left_anti")
    return kept.select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 2048 ids. A null
    text is an empty one, which is its end id alone; long texts make several
    pieces; rows that repeat a doc_id are packed each; an empty table packs nothing."""
    return packing.pack(docs, path("byte_bpe_50k.json"), end_id=0, room=2048, derive={"ids_crc32": F.crc32("ids")})


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("repeated_passages", drop_repeated_passages),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("pack", pack),
]

# Fingerprints, the model and the tokenizer are not SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus of ``documents``. Each stage's result is written to the
    shared scratch folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
