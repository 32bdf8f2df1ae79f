import random

import numpy as np

from tillstream.llm import suffix_dedup

SCHEMA = "doc_id bigint, text string, raw string, found string, alt int"


def brute(rows):
    """Covered bytes per (doc_id, text), documents in order."""
    seen, out = {}, {}
    for doc, text in sorted({r for r in rows if r[0] is not None}, key=lambda r: r[0]):
        data = (text or "").encode()
        cover = bytearray(len(data))
        for s in range(len(data) - 99):
            if seen.setdefault(data[s:s + 100], (doc, s)) != (doc, s):
                cover[s:s + 100] = b"\1" * 100
        out[doc, text] = bytes(cover)
    return out


def runs(cover):
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(cover, np.uint8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def check(spark, rows):
    found = suffix_dedup.dedup(spark.createDataFrame([(d, t, "x", "y", 1) for d, t in rows], SCHEMA)).collect()
    expected = brute(rows)
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.removed == []
            continue
        own = [t for d, t in rows if d == r.doc_id and len((t or "").encode()) == r.n_bytes]
        cover, data = expected[r.doc_id, own[0]], (own[0] or "").encode()
        assert [(x.start, x.end) for x in r.removed] == runs(cover)
        assert bytes(r.kept) == bytes(b for b, c in zip(data, cover) if not c)


def test_against_brute_force(spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeé日") for _ in range(rnd.randint(1, 8))) for _ in range(300)]
    passages = [" ".join(rnd.choice(words) for _ in range(n)) for n in (12, 20, 30, 60, 120)]
    rows = []
    for i in range(160):
        parts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))]
        for _ in range(rnd.randint(0, 3)):
            passage = rnd.choice(passages)
            a = rnd.randint(0, len(passage) // 2)
            parts += [passage[a:], " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 10)))]
        rows.append((i, " ".join(parts)))
    rows += [(200 + i, rows[3][1]) for i in range(30)]
    rows += [(300, "a" * 700), (301, "ab" * 300), (302, "a" * 99), (303, "a" * 100), (304, None), (305, ""), (None, rows[3][1]), (None, None)]
    check(spark, rows)


def test_long_anchor_groups_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_GROUP", 7)
    rnd = random.Random(6)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(230))
    check(spark, [(i, f"{rnd.random()} {passage} {rnd.random()}" * (1 + i % 2)) for i in range(60)])


def test_equal_strings_in_different_parts_of_an_anchor_meet(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_GROUP", 7)
    monkeypatch.setattr(suffix_dedup, "_BATCH", 1)  # no copy is settled before the shuffle
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "5")
    try:
        rnd = random.Random(11)

        def noise():
            return "".join(rnd.choice("abcdefgh ") for _ in range(150))

        hasher, many = suffix_dedup.Hasher(), "".join(rnd.choice("ABCDEFGH") for _ in range(100_000))
        hasher.load(np.frombuffer(many.encode(), np.uint8))
        least = int(hasher.grams(20).argmin())
        core = many[least:least + 20]  # the anchor of whatever holds it
        twins = [noise()[:70] + core + noise()[:70] for _ in range(12)]
        texts = [noise() + (twins[i % 12] if i % 3 == 0 else noise()[:70] + core + noise()[:70]) + noise() for i in range(90)]
        check(spark, list(enumerate(texts)))
        check(spark, [(i, noise() + twins[0] + noise()) for i in range(40)])
    finally:
        spark.conf.set(setting, before)


def test_strings_of_a_common_anchor_are_spread(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_GROUP", 7)
    monkeypatch.setattr(suffix_dedup, "_BATCH", 1)
    taken, compared = [], suffix_dedup._compared
    monkeypatch.setattr(suffix_dedup, "_compared", lambda snippets: taken.append(snippets) or compared(snippets))
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "5")
    try:
        rnd = random.Random(12)
        passage = "".join(rnd.choice("abcdefgh ") for _ in range(230))
        check(spark, [(i, "".join(rnd.choice("abcdefgh ") for _ in range(120)) + passage) for i in range(200)])
    finally:
        spark.conf.set(setting, before)
    sizes = [r.size for r in taken[0].groupBy("h").agg({"bytes": "count", "n": "sum"}).toDF("h", "size", "n").collect()]
    assert len(sizes) > 100 and max(sizes) <= 20  # before: all units of an anchor under one key


def test_repeated_ids_and_empty_table(spark):
    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdef ") for _ in range(300))
    rows = spark.createDataFrame([(1, text, "", "", 0), (1, text, "", "", 0), (2, text, "", "", 0)], SCHEMA)
    found = suffix_dedup.dedup(rows).collect()
    assert sorted((r.doc_id, len(r.kept)) for r in found) == [(1, 300), (1, 300), (2, 0)]
    two = spark.createDataFrame([(1, text, "", "", 0), (1, text[:150], "", "", 0)], SCHEMA)
    kept = [len(r.kept) for r in suffix_dedup.dedup(two).collect()]
    assert sorted(kept) in ([0, 300], [150, 150])  # a hash decides which of them is first
    assert suffix_dedup.dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_text_is_cut_at_whole_characters(spark):
    text = "é" * 80 + "x"
    docs = spark.createDataFrame([(1, "ab" + text, "", "", 0), (2, "c" + text + "d", "", "", 0)], SCHEMA)
    kept = {r.doc_id: r.kept for r in suffix_dedup.dedup(docs, as_text=True).collect()}
    # A run of one sign repeats itself: what begins earlier in the first text goes there too.
    assert kept[2] == "cd" and kept[1].startswith("abé") and "\ufffd" not in kept[1]


def test_blind_trie_orders_strings():
    rnd = random.Random(4)
    strings = [bytes(rnd.choice(b"ab") for _ in range(12)) for _ in range(400)]
    groups = suffix_dedup.blind_trie(strings)
    assert [strings[g[0]] for g in groups] == sorted(set(strings))
    assert all(strings[i] == strings[g[0]] for g in groups for i in g) and sum(map(len, groups)) == 400
    assert suffix_dedup.blind_trie([]) == []


def test_deep_shallow_sort_finds_equal_strings():
    rnd = random.Random(9)
    buffer = b"".join(rnd.choice([b"x" * 70, b"abcdefgh" * 9, b"q" * 40 + b"r"]) for _ in range(60))
    at = np.arange(0, len(buffer) - 100)
    group = at % 3
    found = suffix_dedup.equal_strings(buffer, at, group)
    expected = {}
    for i in range(len(at)):
        expected.setdefault((group[i], buffer[at[i]:at[i] + 100]), []).append(i)
    assert sorted(sorted(f.tolist()) for f in found) == sorted(v for v in expected.values() if len(v) > 1)


def test_query_against_brute_force(spark, tmp_path):
    """The registered query over a small table, every 100-byte string compared."""
    import hashlib

    from tillstream.llm.queries import QUERIES

    rnd = random.Random(12)
    passages = ["".join(rnd.choice("abc é日\n") for _ in range(n)) for n in (99, 100, 130, 400)]
    texts = [None, "", "x" * 260]
    for _ in range(60):
        own = ["".join(rnd.choice("defghijk lmno") for _ in range(rnd.randint(0, 150))) for _ in range(3)]
        texts.append(own[0] + rnd.choice(passages) + own[1] + rnd.choice(["", rnd.choice(passages)]) + own[2])
    texts += [texts[5], texts[9]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    seen, expected = set(), {}
    for doc, text in enumerate(texts):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 99):
            string = raw[at : at + 100]
            if string in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(string)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        expected[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    found = QUERIES["op2_suffix_dedup"](spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == expected
