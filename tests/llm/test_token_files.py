import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path

from tillstream.llm import token_files
from tillstream.session import scratch

TOKENIZER = path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, ids string, start int, block int"


def coder(tokens):
    ids, counts = np.unique(tokens, return_counts=True)
    return token_files.Coder(*token_files.scaled(dict(zip(ids.tolist(), counts.tolist()))))


@pytest.mark.parametrize("n, kinds", [(1, 1), (63, 2), (5_000, 1), (70_001, 900), (300_000, 40_000)])
def test_round_trip(n, kinds):
    rnd = np.random.default_rng(n)
    tokens = np.minimum(rnd.geometric(0.01, n) * 7, kinds).astype(np.int64)
    code = coder(tokens)
    cut = sorted({0, n // 3, n // 2, n})
    parts = [tokens[a:b] for a, b in zip(cut, cut[1:])]
    names = [None, *range(len(parts) - 1)]
    block = code.encode(names, parts, checkpoint=16_384)
    docs, lengths, found = code.decode(block)
    assert docs == names and lengths.tolist() == [len(p) for p in parts] and (found == tokens).all()
    if n > 100_000:
        for k in (1, 2):  # decoding begins at a checkpoint
            rest = code.decode(block, from_checkpoint=k)[2]
            assert 0 < len(rest) < n and (rest == tokens[n - len(rest):]).all()
        assert len(block) < 2 * n  # under two bytes an id


def test_damage_is_noticed():
    tokens = np.random.default_rng(1).integers(0, 50, 2_000)
    code = coder(tokens)
    block = bytearray(code.encode([1], [tokens]))
    block[len(block) // 2] ^= 4
    with pytest.raises(token_files.Corrupt):
        code.decode(bytes(block))
    with pytest.raises(token_files.Corrupt):
        code.decode(b"")


def test_frequencies_fill_the_table():
    counts = {i: 1 for i in range(49_000)} | {7: 10**9}
    ids, freqs = token_files.scaled(counts)
    assert freqs.sum() == 1 << token_files.SCALE and freqs.min() >= 1 and len(ids) == 49_000


def test_files_hold_every_document(spark, monkeypatch):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["the", "cat", "naïve", "x9", "!!"]) for _ in range(rnd.randint(0, 60)))) for i in rnd.sample(range(10**6), 300)]
    rows += [(None, "no id"), (None, None), (5, ""), (6, None), (7, "twice"), (7, "twice"), (8, "long " * 40_000)]
    docs = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], SCHEMA)
    folder = scratch(spark, "test-tokens")
    token_files.write_token_files(docs, folder, TOKENIZER)
    found = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    at, texts = 0, sorted((d is not None, d or 0, tuple(plain.encode(t or "", add_special_tokens=False).ids + [2])) for d, t in rows)
    for r in found:
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
    got = sorted((r.doc_id is not None, r.doc_id or 0, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found)
    assert got == texts


def test_empty_table(spark):
    folder = scratch(spark, "test-tokens")
    token_files.write_token_files(spark.createDataFrame([], SCHEMA), folder, TOKENIZER)
    assert token_files.read_token_files(spark, folder).collect() == []


def test_query(spark, sf):
    from tokenizers import Tokenizer

    from tillstream.llm.queries import QUERIES

    plain, start = Tokenizer.from_file(TOKENIZER), 0
    found = {r.doc_id: r for r in QUERIES["op9_token_files"](spark, sf).collect()}
    for d in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect():
        ids = plain.encode(d.text or "", add_special_tokens=False).ids + [2]
        r = found.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not found
