import random
import re
from collections import Counter

from tillstream.llm import decontamination
from tillstream.llm.queries import QUERIES

WORDS = re.compile(r"[^\W_]+")
DOCS = "doc_id bigint, text string, item_id string, word string, similarity int"


def shingles(text, size=5):
    words = WORDS.findall((text or "").lower())
    size = min(size, len(words))
    return [tuple(words[i:i + size]) for i in range(len(words) - size + 1)] if words else []


def brute(docs, items, threshold=0.8):
    best = {}
    for item, text in items:
        own = shingles(text)
        if not own:
            continue
        for doc, body in docs:
            words = WORDS.findall((body or "").lower())
            size = len(own[0])
            all_own = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
            for start in range(max(1, len(all_own) - len(own) + 1)):
                window = all_own[start:start + len(own)]
                common = sum((Counter(window) & Counter(own)).values())
                if window and (s := common / (len(window) + len(own) - common)) >= threshold and s > best.get((doc, item), (0, 0))[1]:
                    best[doc, item] = (start, s)
    return best


def found(frame):
    return {(r.doc_id, r.item_id): (r.word, r.similarity) for r in frame.collect()}


def test_against_brute_force(spark):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, text(rnd.choice([14, 20, 45, 59]))) for i in range(12)] + [(20, "only three words"), (21, None), (22, ""), (23, "a a a a a a a a a a"),
                                                                               (24, text(150)), (25, items_text := text(30)), (26, items_text)]
    docs = []
    for i in range(120):
        words = text(rnd.randint(0, 60)).split()
        if i % 2:
            passage = rnd.choice(items)[1] or ""
            passage = passage.split()
            for _ in range(rnd.randint(0, 2)):
                if passage:
                    passage[rnd.randrange(len(passage))] = "changed"
            words[len(words) // 2:len(words) // 2] = passage
        docs.append((i, " ".join(words).upper() if i % 3 else ", ".join(words)))
    docs += [(200, None), (201, ""), (202, "ONLY three, words!"), (203, items[0][1].rsplit(" ", 1)[0]), (204, "a " * 30_000), (205, items[24 - 8][1] if len(items) > 16 else "")]
    frame = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in docs + [docs[1]]], DOCS)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    expected = brute(docs, items)
    got = found(decontamination.contaminated(frame, bench))
    assert got.keys() == expected.keys() and len(expected) >= 20
    assert all(got[k][0] == expected[k][0] and abs(got[k][1] - expected[k][1]) < 1e-12 for k in got)


def test_blocks_of_items_and_empty_tables(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"x{i} alpha beta gamma delta epsilon zeta {'eta' if i % 2 else 'theta'} iota kappa") for i in range(6)]
                                 + [(None, "alpha beta gamma delta epsilon zeta eta iota kappa")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta iota kappa"), (2, "x0 alpha beta gamma delta epsilon"),
                                   (None, "zeta theta iota")], "item_id bigint, text string")
    whole = found(decontamination.contaminated(docs, bench))
    assert set(whole) == {(1, 1), (3, 1), (5, 1), (None, 1), (0, 2), (0, None), (2, None), (4, None)}
    monkeypatch.setattr(decontamination, "MAX_BROADCAST", 300)
    assert found(decontamination.contaminated(docs, bench)) == whole
    assert found(decontamination.contaminated(docs.limit(0), bench)) == {} and found(decontamination.contaminated(docs, bench.limit(0))) == {}


def test_query_against_brute_force(spark, sf):
    read = lambda n, k: [(r[k], r.text) for r in spark.read.parquet(f"{sf}/{n}.parquet").select(k, "text").collect()]
    docs, items = read("documents", "doc_id"), read("benchmark", "item_id")
    held = {s for _, t in items for s in shingles(t)}
    some = [(d, t) for d, t in docs if held & set(shingles(t))]
    assert found(QUERIES["op8_decontaminate"](spark, sf)).keys() == brute(some, items).keys()


def test_fingerprints_of_long_items(spark):
    from pyspark.sql import functions as F

    rnd = random.Random(3)
    rows = spark.createDataFrame([([rnd.getrandbits(64) - 2**63 for _ in range(n)],) for n in (1, 2, 9, 63)], "h array<bigint>")
    for longest in (63, 64, 2**14):
        for r in rows.select("h", decontamination.fingerprint(F.col("h"), longest).alias("fp")).collect():
            bits = sum(1 << k for k in range(64) if 2 * sum((h & (2**64 - 1)) >> k & 1 for h in r.h) > len(r.h))
            assert r.fp & (2**64 - 1) == bits
