import random

import numpy as np
import xxhash

from tillstream.llm import simhash
from tillstream.llm.common import components
from tillstream.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, fp string, component_id string, rep int"


def plain_fingerprint(text, size=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + size]), 42) for i in range(max(1, len(words) - size + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def classes(prints, radius):
    """Least id reachable, by comparing all."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_texts(n, seed):
    rnd = random.Random(seed)
    base = [[rnd.choice(["the", "cat", "dog", "runs", "é", "Über", "x1"]) + str(rnd.randint(0, 50)) for _ in range(150)] for _ in range(6)]
    texts = []
    for _ in range(n):
        words = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = str(rnd.random())
        texts.append(" ".join(words))
    return texts


def test_against_brute_force(spark, monkeypatch):
    texts = near_texts(150, 1) + [None, "", " \t\n", "one", "One two", "a b c", "\x0b\x0c", "the " * 50_000]
    rows = [(i, t, "x", "y", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + [(None, texts[0], "x", "y", 0), rows[5]], SCHEMA)
    expected = classes({i: plain_fingerprint(t) for i, t in enumerate(texts)}, 2)
    for tile in (simhash.TILE, 4):  # a small tile deals every bucket out in chunks
        monkeypatch.setattr(simhash, "TILE", tile)
        found = simhash.near_duplicates(docs).collect()
        assert len(found) == len(texts) + 2
        for r in found:
            if r.doc_id is None:
                assert r.component_id is None
            else:
                assert int(r.fp.hex(), 16) == plain_fingerprint(texts[r.doc_id]) and r.component_id == expected[r.doc_id]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_query_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    expected = classes(prints, 2)
    found = QUERIES["op7_simhash_near_dup"](spark, sf).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {i: (f"{prints[i]:016x}", expected[i]) for i in prints}


def test_one_id_with_two_texts_links_them(spark):
    a, b = near_texts(1, 3)[0], near_texts(1, 4)[0]
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b)], "doc_id bigint, text string")
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {1}


def test_bit_sliced_pairs_equal_plain_ones():
    rnd = np.random.default_rng(2)
    for width, radius in ((8, 2), (8, 0), (32, 56)):
        sizes = np.array(sorted([1, 2, 3, 70, 130, 5, 2], reverse=True))
        prints = rnd.integers(0, 256, (sizes.sum(), width), dtype=np.uint8)
        for i in range(0, len(prints) - 3, 3):  # some near ones
            prints[i + 3] = prints[i] ^ (1 << rnd.integers(0, 8)) * (np.arange(width) < rnd.integers(0, 4))
        bucket = np.repeat(np.arange(len(sizes)), sizes)
        expected = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if bucket[i] == bucket[j]
                    and int(np.bitwise_count(prints[i] ^ prints[j]).sum()) <= radius}
        found = {(int(a), int(b)) for i, j in simhash.near_pairs(prints, sizes, radius, list(range(8 * width))) for a, b in zip(i, j)}
        assert found == expected


def test_similarity_is_checked(spark):
    rnd = random.Random(8)
    words = [str(rnd.random()) for _ in range(200)]
    near, far = list(words), list(words)
    near[50] = "changed"                      # five of 196 shingles
    for i in range(10, 190, 30):              # thirty of 196: 0.73
        far[i] = "changed"
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))], "doc_id bigint, text string")
    found = simhash.near_duplicates(docs, 5, 4, 128, simhash.band_keys(256, 4), similarity=0.8).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 3}


def near(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = simhash.near_duplicates(docs, 5, 4, 56, simhash.band_keys(256, 13), similarity=0.8).collect()
    return {r.doc_id: r.component_id for r in found}


def test_similarity_takes_sets_of_shingles(spark):
    rnd = random.Random(21)
    line = " ".join(str(rnd.random()) for _ in range(7)) + " "
    tails = [" ".join(str(rnd.random()) for _ in range(500)) for _ in range(3)]
    rows = [(i, line * 100 + t) for i, t in enumerate(tails)]  # equal fingerprints if repeats count
    rows.append((10, tails[0] + " " + tails[0]))
    rows.append((11, tails[0] + (" " + tails[0]) * 2 + (" " + line) * 0))
    rows.append((12, (line * 60 + tails[1] + " ") + line * 2))
    found = near(spark, rows)
    assert [found[i] for i in (0, 1, 2)] == [0, 1, 2]
    assert found[10] == found[11] and found[12] == 1


def test_similar_pairs_are_all_linked(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FREQUENT", 5)
    rnd, texts = random.Random(31), []
    for family in range(60):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(204)]
        for _ in range(8):
            own = list(base)
            for place in rnd.sample(range(204), rnd.randint(3, 7)):
                own[place] = f"v{rnd.randrange(10**6)}"
            texts.append(" ".join(own))
    sets = [simhash.shingle_set(t.encode(), 5) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i // 8 * 8, i):
            common = len(sets[i] & sets[j])
            if common >= 0.8 * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert near(spark, list(enumerate(texts))) == {i: find(i) for i in range(len(texts))}


def test_components(spark):
    rnd = random.Random(3)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(400, 480)] + [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(40)]
    expected = {}
    for a, b in pairs:
        expected.setdefault(a, a), expected.setdefault(b, b)
    moved = True
    while moved:
        moved = False
        for a, b in pairs:
            least = min(expected[a], expected[b])
            moved |= expected[a] != least or expected[b] != least
            expected[a] = expected[b] = least
    found = components(spark.createDataFrame(pairs + [(None, 3), (7, None)], "a bigint, b bigint")).collect()
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert {r.node: r.root for r in found} == {i: r for i, r in expected.items() if i in linked} and len(found) == len(linked)


def test_a_common_passage_makes_few_candidates(spark):
    """Different texts around one passage of 60 words: candidates must not grow with the square."""
    rnd = random.Random(77)
    passage = " ".join(f"p{rnd.randrange(10**6)}" for _ in range(60))
    rows = []
    for i in range(1600):
        own = [f"w{rnd.randrange(10**6)}" for _ in range(rnd.randint(20, 60))]
        cut = rnd.randint(0, len(own))
        rows.append((i, " ".join([*own[:cut], passage, *own[cut:]])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    reps = docs.select(docs["doc_id"].alias("rep"), docs["doc_id"].alias("root"))
    assert simhash.unlinked_pairs(docs, reps, 5, 0.8, "doc_id", "text").count() < 10 * 1600
