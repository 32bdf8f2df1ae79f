import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

from tillstream.llm import packing
from tillstream.llm.tokens import Memo

TOKENIZER = path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, length string, ids string, part int"


def encode(text, end=0):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids + [end]


def test_plan_is_best_fit_decreasing():
    rnd = random.Random(3)
    for _ in range(60):
        room = rnd.choice([7, 16, 50])
        lengths = sorted((rnd.randint(1, room) for _ in range(rnd.randint(1, 120))), reverse=True)
        left = []  # one document at a time, into the fullest sequence that takes it
        for n in lengths:
            fits = [i for i, r in enumerate(left) if r >= n]
            if fits:
                left[min(fits, key=lambda i: left[i])] -= n
            else:
                left.append(room - n)
        histogram = {n: lengths.count(n) for n in set(lengths)}
        slots = packing.plan(histogram, room)
        taken, ranks = {}, {n: [] for n in histogram}
        for n, rank, count, first, offset in slots:
            ranks[n] += range(rank, rank + count)
            for s in range(first, first + count):
                taken.setdefault(s, []).append((offset, n))
        assert all(sorted(r) == list(range(histogram[n])) for n, r in ranks.items())
        for places in taken.values():
            places.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
            assert places[0][0] == 0 and sum(places[-1]) <= room
        assert len(taken) == len(left)


def test_packs_every_case(spark):
    long = " ".join(f"word{i}" for i in range(4_000))
    rows = [(1, "a short text", "x", "y", 3), (2, None, None, None, None), (3, "", "x", "y", 3), (None, "no id", "x", "y", 3),
            (4, long, "x", "y", 3), (5, "twice", "x", "y", 3), (5, "twice", "x", "y", 3), (6, "two  spaces\n\nand lines", "x", "y", 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    packed = packing.pack(docs, TOKENIZER, room=512).collect()
    expected = []
    for doc, text, *_ in rows:
        ids, start, piece = encode(text), 0, 0
        size = len(ids) % 512 or 512
        while start < len(ids):
            expected.append((doc, piece, start, tuple(ids[start:start + size])))
            start, piece, size = start + size, piece + 1, 512
    found = [(r.doc_id, r.piece, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in packed]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    places = {}
    for r in packed:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 512
    whole = packing.sequences(spark.createDataFrame(packed)).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(len(e[3]) for e in expected)


def test_empty_table_and_derived_columns(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), TOKENIZER).collect() == []
    docs = spark.createDataFrame([(1, "abc", "", "", 0)], SCHEMA)
    row = packing.pack(docs, TOKENIZER, derive={"crc": F.crc32("ids")}).first()
    assert "ids" not in row and row.crc == zlib.crc32(np.array(encode("abc"), "<u4").tobytes())


@pytest.mark.parametrize("name, kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_memo_gives_the_tokenizers_ids(name, kind):
    from tokenizers import Tokenizer

    rnd = random.Random(1)
    signs = list("ab ,.\n\t'!1é ²\x1c s<|>\u0301")
    texts = ["", " ", "a  b", " a", "a ", "\na\n", "a \nb", "it's 's", "x<|endoftext|> y", "foo, bar. (baz)", "日本語 テスト", "! !", "a ! b", "ab" * 900]
    texts += ["".join(rnd.choice(signs) for _ in range(rnd.randint(1, 30))) for _ in range(800)]
    plain, memo = Tokenizer.from_file(path(name)), Memo(path(name), kind, limit=50)
    for text in texts * 2:
        assert np.frombuffer(memo.encode([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("name, kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_a_repeated_chunk_is_looked_up_once(name, kind, monkeypatch):
    """The texts of a group share their look-ups."""
    from tillstream.llm import tokens

    looked, get = [], tokens.Recent.get
    monkeypatch.setattr(tokens.Recent, "get", lambda self, chunks: looked.extend(chunks) or get(self, chunks))
    memo = Memo(path(name), kind)
    memo.encode(["River stone, river!!\nStone river%%%"] * 500)
    assert len(looked) < 100


def test_query_against_brute_force(spark, tmp_path):
    """The registered query over a small table: ids of the tokenizer itself, and no
    more sequences than best-fit decreasing needs, one piece at a time."""
    from tillstream.llm.queries import QUERIES

    rnd = random.Random(6)
    texts = [None, "", "é日 words"] + [" ".join(rnd.choice(["river", "Haus", "12", "x,", "thble"]) for _ in range(rnd.choice([3, 300, 900, 2500]))) for _ in range(40)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op1_pack"](spark, str(tmp_path)).collect()
    ids = {doc: np.array(encode(t), "<u4") for doc, t in enumerate(texts)}
    pieces, places = {}, {}
    for r in found:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, own in pieces.items():
        own.sort()
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert [s for _, s, _ in own] == [sum(n for _, _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, _, n in own) == len(ids[doc]) and all(n == 2048 for _, _, n in own[1:])
        assert len(own) == -(-len(ids[doc]) // 2048)
    assert pieces.keys() == ids.keys()
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 2048
    left = []
    for n in sorted((n for own in pieces.values() for _, _, n in own), reverse=True):
        fits = [i for i, room in enumerate(left) if room >= n]
        if fits:
            left[min(fits, key=lambda i: left[i])] -= n
        else:
            left.append(2048 - n)
    assert len(places) <= len(left)
