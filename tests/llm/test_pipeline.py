"""Every stage against a plain version of its rule, on what its predecessor kept."""

from collections import Counter

import pytest
from test_decontamination import brute as leaks_of
from test_suffix_dedup import brute as covered, runs

import corpus_pipeline as cp
from tillstream.llm import language, suffix_dedup

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Each stage's input and output, over the documents and some odd rows."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(cp.COLUMNS)
    some = docs.filter("length(text) > 800").orderBy("doc_id").first()
    odd = [(900_001, None, "en", "s", None), (900_002, "", None, None, 0), (900_003, "12 34 !!", "en", "s", 8),
           (900_004, some.text + " One more sentence.", some.lang, "s", 1), (900_005, some.text, some.lang, None, 1),
           (900_005, some.text, some.lang, None, 1), (None, "The house and the garden. " * 30, "en", "s", 1)]
    docs = docs.union(spark.createDataFrame(odd, SCHEMA))
    out = {}
    for name, stage in cp.STAGES:
        after = stage(spark, docs, sf)
        rows = after.collect()
        out[name] = (docs.collect(), rows)
        docs = spark.createDataFrame(rows, after.schema)
        if name != "pack":
            assert after.columns == cp.COLUMNS
    return out


def test_language(spark, stages):
    before, after = stages["language"]
    model = language.fit(spark.createDataFrame(before, SCHEMA))
    judged = [(r, *language.Scorer(model)(r.text)) for r in before]
    expected = [r for r, lang, score in judged if lang != "und" and score >= cp.LEAST_SCORE]
    assert Counter(after) == Counter(expected) and {r.doc_id for r in before} - {r.doc_id for r in after} >= {900_001, 900_002, 900_003}
    assert len(after) >= len(before) - 6  # clean documents stay


def test_near_copies(stages):
    before, after = stages["near_copies"]

    def shingles(text):
        words = text.encode().lower().split()
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}

    named = sorted({(r.doc_id, r.text) for r in before if r.doc_id is not None})
    sets, root = [shingles(t) for _, t in named], list(range(len(named)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(named)):
        for j in range(i + 1, len(named)):
            common = len(sets[i] & sets[j])
            if common >= 0.8 * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    expected = sorted(named[i][0] for i in range(len(named)) if find(i) == i)
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == expected
    assert sum(r.doc_id is None for r in after) == sum(r.doc_id is None for r in before) == 1


def test_repeated_passages(stages):
    before, after = stages["repeated_passages"]
    cover = covered([(r.doc_id, r.text) for r in before])
    expected = {}
    for (doc, text), bits in cover.items():
        data = text.encode()
        cut = suffix_dedup.whole_signs(data, runs(bits))
        ends = [0, *(e for _, e in cut)]
        left = b"".join(data[a:b] for a, b in zip(ends, [*(s for s, _ in cut), len(data)])).decode()
        if left:
            expected[doc] = left
    assert {r.doc_id: r.text for r in after if r.doc_id is not None} == expected
    assert all(r.n_chars == len(r.text) for r in after if r.doc_id is not None)
    assert sum(map(len, expected.values())) < sum(len(t) for _, t in cover)


def test_leaks(spark, sf, stages):
    before, after = stages["benchmark_leaks"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaked = {doc for doc, _ in leaks_of([(r.doc_id, r.text) for r in before], items)}
    assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before if r.doc_id not in leaked)


def test_pack(stages):
    before, after = stages["pack"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    places = {}
    for r in after:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 2048
    assert len(places) <= -(-sum(r.length for r in after) // 2048) + 1


def test_run_is_its_stages(spark, sf):
    found = cp.run(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert 0 < len({r.doc_id for r in found}) <= docs.count()


def test_empty_documents(spark, sf):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES:
        after = stage(spark, docs, sf)
        assert after.collect() == []
        docs = docs if "text" not in after.columns else after
