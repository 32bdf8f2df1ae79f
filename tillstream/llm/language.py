"""Language identification: known words first, character n-grams for the rest."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import long_rows, map_texts, written

_WORD = re.compile(r"[^\W\d_]+")
_COUNTS = "lang string, n int, gram string, times bigint"
_SHARED = 0.02        # weight of the mean over all languages in an entry's frequency
LONGEST = 5           # characters of the longest n-gram
UNDETERMINED = "und"


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether a document is set aside for measuring: crc32 of the id as text."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def _padded(word: str) -> str:
    return f"^{word}$"


def sampled(labelled: DataFrame, rows_per_language: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """At most ``rows_per_language`` rows of each language, chosen by a hash of
    the id. Counts per language give each a threshold that half as many rows
    more pass on average; only those few are ranked, so neither a common
    language nor its texts gather in one task."""
    usable = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    chance = F.pmod(F.xxhash64(F.col(id_col), F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    counts = written(usable.groupBy(lang_col).agg(F.count(F.lit(1)).alias("_rows")), "language-rows")
    few = usable.join(counts, lang_col).filter(chance * F.col("_rows") <= 1.5 * rows_per_language)
    rank = Window.partitionBy(lang_col).orderBy(F.xxhash64(id_col), F.col(id_col))
    return few.withColumn("_rank", F.row_number().over(rank)).filter(F.col("_rank") <= rows_per_language)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows_per_language: int = 2_000, min_times: int = 2, max_entries: int = 150_000) -> dict:
    """The word and n-gram tables of a bounded sample of labelled rows.

    The words and n-grams of 1 to 5 characters of at most ``rows_per_language``
    rows per language are counted; of what occurs at least ``min_times`` times
    the ``max_entries`` most frequent entries reach the driver. Rows without
    text or label teach nothing.
    """
    sample = sampled(labelled, rows_per_language, id_col, text_col, lang_col).select(
        F.lit(0).alias("_id"), F.concat_ws("\n", lang_col, text_col).alias("_text"))

    def rows(pairs):
        by_lang: dict[str, Counter] = {}

        def out():
            for lang, words in by_lang.items():
                grams = Counter()
                for word, times in words.items():
                    yield lang, 0, word, times
                    padded = _padded(word)
                    for n in range(1, LONGEST + 1):
                        for i in range(len(padded) - n + 1):
                            grams[n, padded[i : i + n]] += times
                for (n, gram), times in grams.items():
                    yield lang, n, gram, times
            by_lang.clear()

        for _, text in pairs:
            lang, _, text = text.partition("\n")
            words = by_lang.setdefault(lang, Counter())
            words.update(_WORD.findall(text.lower()))
            if sum(map(len, by_lang.values())) > 200_000:
                yield from out()
        yield from out()

    counted = map_texts(sample, rows, _COUNTS, "_id", "_text").groupBy("n", "gram", "lang").agg(F.sum("times").alias("times"))
    counted = written(counted, "language-counts")
    kept = counted.groupBy("n", "gram").agg(F.sum("times").alias("total")).filter(F.col("total") >= min_times)
    kept = kept.orderBy(F.desc("total"), "n", "gram").limit(max_entries)
    entries = counted.join(kept, ["n", "gram"]).select("n", "gram", "lang", "times").toArrow().to_pydict()
    langs = sorted(set(entries["lang"]))
    column = {lang: i for i, lang in enumerate(langs)}
    times: dict[int, dict[str, np.ndarray]] = {n: {} for n in range(LONGEST + 1)}
    for n, gram, lang, count in zip(entries["n"], entries["gram"], entries["lang"], entries["times"]):
        own = times[n].get(gram)
        if own is None:
            own = times[n][gram] = np.zeros(len(langs), np.float32)
        own[column[lang]] = count
    totals = {n: np.sum(list(table.values()), axis=0, dtype=np.float64) if table else np.zeros(len(langs)) for n, table in times.items()}
    order = sorted(range(len(langs)), key=lambda i: (-totals[0][i], langs[i]))
    known: dict[int, dict[str, int]] = {n: {} for n in times}
    scores = np.zeros((sum(map(len, times.values())), len(langs)), np.float32)
    for n, table in times.items():
        for gram, own in table.items():
            share = own[order] / np.maximum(totals[n][order], 1)
            known[n][gram] = row = sum(map(len, known.values()))
            # A language that lacks the entry gets a part of its mean share, so
            # that one with little text does not take what it never saw for likely.
            scores[row] = np.log((1 - _SHARED) * share + _SHARED * share.mean())
    return {"langs": [langs[i] for i in order], "known": known, "scores": scores}


class Scorer:
    """Scores texts by a fitted model; remembers what words scored."""

    def __init__(self, model: dict, limit: int = 150_000):
        self._langs, self._known, self._limit = model["langs"], model["known"], limit
        self._fitted = model["scores"]
        self._forget()

    def _forget(self) -> None:
        self._row: dict[str, int] = {}
        self._scores = np.zeros((1024, len(self._langs)), np.float32)

    def _word(self, word: str) -> np.ndarray:
        """Log frequencies of a known word; of an unseen one the mean over its
        known n-grams of the longest size that has any."""
        if (found := self._known[0].get(word)) is not None:
            return self._fitted[found]
        padded = _padded(word)
        for n in range(LONGEST, 0, -1):
            table = self._known[n]
            grams = [table[g] for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) in table]
            if grams:
                return self._fitted[grams].mean(axis=0)
        return np.zeros(len(self._langs), np.float32)

    def _add(self, word: str) -> int:
        at = len(self._row)
        if at == len(self._scores):
            self._scores = np.concatenate([self._scores, np.zeros_like(self._scores)])
        self._scores[at] = self._word(word)
        self._row[word] = at
        return at

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = _WORD.findall(text.lower()) if text else []
        if not words or not self._langs:
            return UNDETERMINED, 0.0
        if len(self._row) > self._limit:
            self._forget()
        get = self._row.get
        rows = [i if (i := get(w)) is not None else self._add(w) for w in words]
        total = self._scores[rows].sum(axis=0, dtype=np.float64)
        total *= min(1.0, 20 / len(words))  # words of a text are not independent: no more than twenty count
        total = np.exp(total - total.max())
        best = int(total.argmax())
        score = float(total[best] / total.sum())
        return self._langs[best], score if math.isfinite(score) else 0.0


def with_language(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` for every row: ``und`` with
    score 0 where the text is null or has no letter (also when nothing was
    learned), else the best language and its share in the likelihoods. Equal
    scores go to the language with more words learned, then by name. Whole texts
    are read; repeated rows and null ids are judged like others; columns that
    have these names are replaced. The model goes to the tasks; ``fit`` bounds
    its size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    docs = long_rows(docs)
    names = docs.columns

    def rows(batches):
        score = Scorer(shared.value)
        for batch in batches:
            found = [score(t) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*names, "lang_pred", "score"])

    return docs.mapInArrow(rows, StructType([*docs.schema, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of ``with_language``."""
    typed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return with_language(typed, model).select("doc_id", "lang_pred", "score")
