"""Token ids of whole texts, by the tokenizers library, with a memo of chunks.

Both kinds of vocabulary never merge across a word's border, so a text can be
cut there and each distinct chunk needs the tokenizer once per task. The cuts
are only made where the result provably stays the same.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RUN_OR_ZERO = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}|\x00"
_WORD_START = re.compile(r"(?<=\S)(?= \S)")
_SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space for str.split, signs for the tokenizer
_SIGNS = tuple(",.;:?)!#$%&*")
_WORD_AND_SIGNS = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([,.;:?)!#$%&*]+)")  # letters and signs are never one token
_LONG = 64  # longer chunks are not worth remembering
_AT_ONCE = 1_000


def _of_latin(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


class Recent:
    """Ids by chunk, of the chunks met last: when ``limit`` new ones have come,
    those not met since the time before are forgotten."""

    def __init__(self, limit: int):
        self._limit = limit
        self._now: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def get(self, chunks: list[str]) -> tuple[list[bytes | None], list[int]]:
        """Ids of each chunk, and where they are missing."""
        found = list(map(self._now.get, chunks))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing and self._before:
            for i in missing:
                if (ids := self._before.get(chunks[i])) is not None:
                    found[i] = self._now[chunks[i]] = ids
            missing = [i for i in missing if found[i] is None]
        return found, missing

    def add(self, ids: dict[str, bytes]) -> None:
        self._now.update((c, i) for c, i in ids.items() if len(c) <= _LONG)
        if len(self._now) > self._limit:
            self._before, self._now = self._now, {}


class Memo:
    """``encode(texts)`` gives each text's ids as little-endian 32-bit integers.

    ``kind`` is ``byte`` for byte-level vocabularies, whose words keep the space
    before them, or ``word`` for those that drop white space. About twice
    ``limit`` chunks are remembered.
    """

    def __init__(self, path: str, kind: str, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._byte = kind == "byte"
        # The same vocabulary for words of letters alone, one a line: nothing to
        # normalise and no pattern to match. A token that opens (byte) or ends
        # (word) a word tells where the next begins.
        self._lines = Tokenizer.from_file(path)
        self._lines.normalizer = normalizers.Sequence([])
        self._lines.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)  # what each letter's bytes are written as
        self._signs = {ord(c): signs.pre_tokenize_str(c)[0][0] for c in [" ", *map(chr, range(0xC0, 0x100))]}
        vocabulary = self._tokenizer.get_vocab()
        self._edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self._edge[[i for t, i in vocabulary.items() if (t.startswith("Ġ") if self._byte else t.endswith("</w>"))]] = True
        # Between two chunks: text that the vocabulary makes one token of, and that token.
        self._between = "\n" if self._byte else " ! "
        self._plain = re.compile(r" ?[^\s!]{1,200}" if self._byte else r"[^\s!]{1,200}")
        (self._mark,) = self._tokenizer.encode(self._between, add_special_tokens=False).ids
        self._word = re.compile(" [A-Za-zÀ-ÖØ-öø-ÿ]{1,200}" if self._byte else "[a-zß-öø-ÿ]{1,200}")
        self._known = Recent(limit)

    def encode(self, texts: list[str]) -> list[bytes]:
        return self._byte_level(texts) if self._byte else self._word_level(texts)

    def _byte_level(self, texts: list[str]) -> list[bytes]:
        # A space before a sign that is no space opens a word, and so does a
        # single line break on either side. Runs of white space are left alone.
        column = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(column, _RUN_OR_ZERO)
        even = column.filter(pc.invert(odd))
        even = pc.replace_substring(pc.replace_substring(even, "\n", "\0\n\0"), " ", "\0 ")
        even = iter(self._coded(pc.split_pattern(even, "\0")))
        return [b"".join(self._look_up(_WORD_START.split(text))) if own else next(even)
                for text, own in zip(texts, odd.to_pylist())]

    def _word_level(self, texts: list[str]) -> list[bytes]:
        whole, rest = {}, []
        for i, text in enumerate(texts):
            if _of_latin(text):
                text = text.lower()  # sign by sign, as the tokenizer does; fewer words to tell apart
                spaces = "\x85" in text or "\xa0" in text
            else:
                spaces = True
            if any(sign in text for sign in _SEPARATORS):
                whole[i] = self._look_up([text])[0]
            else:
                rest.append(" ".join(text.split()) if spaces else text)
        rest = iter(self._coded(pc.ascii_split_whitespace(pa.array(rest, pa.large_string()))))
        return [whole[i] if i in whole else next(rest) for i in range(len(texts))]

    def _coded(self, lists: pa.Array) -> list[bytes]:
        """The ids of each list of chunks; a chunk is looked up once."""
        met = lists.flatten().dictionary_encode()
        ids = self._look_up(met.dictionary.to_numpy(zero_copy_only=False).tolist())
        placed = pa.array(ids, pa.large_binary()).take(met.indices)
        _, ends, raw = placed.buffers()
        if raw is None:
            return [b""] * len(lists)
        ends = np.frombuffer(ends, "<i8", len(placed) + 1)[lists.offsets.to_numpy()].tolist()
        raw = memoryview(raw)
        return [bytes(raw[a:b]) for a, b in zip(ends, ends[1:])]

    def _look_up(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk. Of a new word the signs that follow it are cut off
        first, as the word itself may be known."""
        found, missing = self._known.get(chunks)
        if not missing:
            return found
        new = {chunks[i] for i in missing}
        signed = {c: m.groups() for c in new if c.endswith(_SIGNS) and (m := _WORD_AND_SIGNS.fullmatch(c))}
        words = list(({w for w, _ in signed.values()} | new) - signed.keys())
        coded = {w: ids for w, ids in zip(words, self._known.get(words)[0]) if ids is not None}
        coded |= self._tokenised([w for w in words if w not in coded])
        signs = list({s for _, s in signed.values()})
        signs = dict(zip(signs, self._look_up(signs))) if signs else {}
        coded |= {c: coded[w] + signs[s] for c, (w, s) in signed.items()}
        self._known.add(coded)
        for i in missing:
            found[i] = coded[chunks[i]]
        return found

    def _tokenised(self, new: list[str]) -> dict[str, bytes]:
        """Ids of each chunk, by the tokenizer: words line by line, other plain
        chunks in one text with marks between, the rest one by one."""
        coded: dict[str, bytes] = {}
        words, plain, single = [], [], []
        for c in new:
            (words if self._word.fullmatch(c) else plain if self._plain.fullmatch(c) else single).append(c)
        for at in range(0, len(words), _AT_ONCE):
            some = words[at : at + _AT_ONCE]
            if found := self._by_line(some):
                coded |= found
            else:
                plain += some
        for at in range(0, len(plain), _AT_ONCE):
            some = plain[at : at + _AT_ONCE]
            ids = array("I", self._tokenizer.encode_batch_fast([self._between.join(some)], add_special_tokens=False)[0].ids)
            ends = [i for i, one in enumerate(ids) if one == self._mark]
            if len(ends) != len(some) - 1:
                single += some
                continue
            raw = ids.tobytes()
            coded.update((c, raw[4 * a : 4 * b]) for c, a, b in zip(some, [0, *(e + 1 for e in ends)], [*ends, len(ids)]))
        for c, e in zip(single, single and self._tokenizer.encode_batch_fast(single, add_special_tokens=False)):
            coded[c] = array("I", e.ids).tobytes()
        return coded

    def _by_line(self, words: list[str]) -> dict[str, bytes]:
        text = "\n".join([w if w.isascii() else w.translate(self._signs) for w in words]).replace(" ", self._signs[32])
        ids = np.array(self._lines.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        edges = np.flatnonzero(self._edge[ids])
        if len(edges) != len(words):
            return {}
        cuts = [*(4 * edges).tolist(), 4 * len(ids)] if self._byte else [0, *(4 * edges + 4).tolist()]
        raw = ids.tobytes()
        return {w: raw[a:b] for w, a, b in zip(words, cuts, cuts[1:])}


@lru_cache(maxsize=4)
def memo(path: str, kind: str) -> Memo:
    """The memo of this process, which Spark keeps for the tasks that follow."""
    return Memo(path, kind)


def groups(pairs, texts: int = 2_048, characters: int = 1 << 22):
    """Lists of (id, text) pairs, ended by count or size."""
    part, size = [], 0
    for pair in pairs:
        part.append(pair)
        size += len(pair[1] or "")
        if len(part) >= texts or size >= characters:
            yield part
            part, size = [], 0
    if part:
        yield part
