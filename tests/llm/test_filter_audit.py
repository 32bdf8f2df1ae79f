import random
import re
from itertools import permutations

import numpy as np
import pytest

from tillstream.llm import filter_audit as fa


def plain(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def machine(texts):
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(r) for r in raw]).astype(np.int64)
    return fa.statistics(np.frombuffer(b"".join(raw), np.uint8), offsets).tolist()


def test_statistics_equal_plain_counts():
    rnd = random.Random(1)
    for _ in range(200):
        texts = ["".join(rnd.choice("ab AB\t\n é日#$%&*| \x0b\x0c\r😀\x1c ") for _ in range(rnd.choice([0, 0, 1, 3, 20, 200]))) for _ in range(rnd.randint(0, 12))]
        assert machine(texts) == [plain(t) for t in texts]
    long = ["x" * 40 + str(i % 50) for i in range(3000)]
    assert machine([" ".join(long), "", " ".join(long)]) == [plain(" ".join(long)), plain(""), plain(" ".join(long))]


def test_words_of_one_hash_are_told_apart(monkeypatch):
    """With every hash equal, only the comparison of bytes can tell words apart."""
    monkeypatch.setattr(fa, "_hashes", lambda at8, start, size, seed: np.zeros(len(start), np.uint64))
    texts = ["aa ab aa abcdefghij abcdefghik abcdefghij", "aa", "", "ab ab"]
    assert machine(texts) == [plain(t) for t in texts]


def brute_force(docs, labels):
    good, toxic = {k for k, q, _ in labels if q == 1 and k is not None}, {k for k, _, t in labels if t == 1 and k is not None}
    judged = []
    for key, part, text in docs:
        n_words, n_distinct, capitals, points, symbols = plain(text or "")
        same = any(k is not None and key is not None and k < key and (t or "") == (text or "") for k, _, t in docs)
        fails = {"A": n_words < 50, "B": 100 * n_distinct < 65 * n_words, "C": 100 * capitals > 5 * points, "D": symbols > 0, "E": same}
        judged.append((part or "", fails, key in good, key in toxic))
    rows, shapley = {}, {}
    for part in {p for p, *_ in judged}:
        own = [j for j in judged if j[0] == part]
        for order in permutations("ABCDE"):
            left, gone = own, []
            for step, f in enumerate(order, 1):
                out = [j for j in left if j[1][f]]
                left = [j for j in left if not j[1][f]]
                rows[part, "".join(order), step] = [
                    len(left), len(out), sum(j[1][f] for j in gone), sum(j[1][f] and sum(j[1].values()) == 1 for j in own),
                    sum(j[2] for j in out), sum(j[3] for j in out)]
                gone += out
                shapley[part, f] = shapley.get((part, f), 0) + len(out)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def test_audit_equals_brute_force(spark):
    rnd = random.Random(4)
    words = "the of AND tree # house 50% river SKY".split()
    docs = []
    for key in range(120):
        text = " ".join(rnd.choice(words[: rnd.randint(3, 9)]) + rnd.choice(["", str(rnd.randint(0, 300))]) for _ in range(rnd.choice([5, 49, 50, 90])))
        docs.append((key, rnd.choice(["web", "books", "", None]), rnd.choice([text, text, docs[rnd.randint(0, len(docs) - 1)][2] if docs else text, "", None])))
    docs += [(None, "web", "solo"), (None, "web", "solo"), (3, "web", docs[3][2]), (200, "long", "Word " * 60_000), (201, "Ü", "ä" * 500)]
    labels = [(k, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for k in range(0, 90)] + [(5, 1, 0), (5, 0, 1), (None, 1, 1), (9999, 1, 1)]
    frame = spark.createDataFrame([(k, s, t, "clash", 1) for k, s, t in docs], "doc_id bigint, source string, text string, mask string, n_words int").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    result = fa.audit(frame, marks).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in result}
    assert len(result) == len(found) and found == brute_force(docs, labels)


def test_empty_tables_and_columns(spark):
    docs = spark.createDataFrame([(1, "a", "x")], "doc_id bigint, source string, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert fa.audit(docs.limit(0), labels).collect() == []
    assert fa.audit(docs, labels).filter("removed > 0").count() == 120  # one document of one word fails A alone
    named = docs.selectExpr("doc_id", "text", "1.5 AS n_words", "array(1) AS odd")
    assert fa.with_statistics(named).drop("odd").collect() == [(1, 1, 1, 0, 1, 0)]
    assert fa.with_statistics(named.limit(0)).collect() == []


@pytest.mark.parametrize("own", range(5))
def test_shapley_counts_every_order(own):
    from math import factorial

    assert sum(factorial(s.count("1")) * factorial(4 - s.count("1")) for s in (bin(b) for b in range(32) if not b >> own & 1)) == factorial(5)
