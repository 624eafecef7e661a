"""Token ids of whole texts, in Arrow batches; tokenizers are read from a path, never trained."""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
MAX_CACHED_PIECES = 250_000
MAX_CACHED_CHARS = 64  # of a piece; so all that is remembered has a bounded size
# Fixed value: the white space of the splitting pattern.
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_GAP = 100_000  # white-space characters that the pattern's matcher takes at once; its stack ends at a million
_LONG_GAP = re.compile(rf"[{_SPACES}]{{{LONG_GAP},}}")

# The splitting pattern of the word tokenizer, for letters and numbers of Latin-1.
_LETTERS = r"a-z\x{aa}\x{b5}\x{ba}\x{df}-\x{f6}\x{f8}-\x{ff}"
_NUMBERS = r"0-9\x{b2}\x{b3}\x{b9}\x{bc}-\x{be}"
_NO_WORD = rf"('s|'t|'re|'ve|'m|'ll|'d|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+)"
_LATIN = r"\A[\t\n\r\x20-\x7e\x{a1}-\x{ff}]*\z"
_GAPS = re.compile(r"[ \t\n\r]+")
# Byte-level vocabularies spell a byte as the Latin-1 letter of its number if that is visible, the others
# in turn from letter 256 on.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SPELLING = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class WordTokenizer:
    """Ids of a tokenizer that drops white space and never joins text across it.

    Texts are cut into pieces that the tokenizer handles independently: Latin-1 texts, column by
    column in Arrow, at its own splitting pattern, others at ASCII white space. The different
    pieces of a column are looked up; those of at most MAX_CACHED_CHARS characters are encoded
    by the tokenizer once and remembered, up to a number of pieces. Longer pieces and texts
    with special tokens are encoded where they occur.
    """

    def __init__(self, path: str, most: int = MAX_CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.most, self.known, self.older = most, {}, {}

    def _whole(self, pieces: list[str]) -> Iterator[list[int]]:
        return (c.ids for c in self.whole.encode_batch_fast(pieces, add_special_tokens=False))

    def _bare(self, pieces: list[str]) -> Iterator[list[int]]:
        """For pieces that are normalised and split already: only their bytes' letters are looked up."""
        merge = self.model.tokenize
        for p in pieces:
            spelt = p if p.isascii() else p.encode().decode("latin-1").translate(_SPELLING)
            yield [t.id for t in merge(spelt)]

    def _look_up(self, pieces: list[str], ids_of) -> list[bytes]:
        """Packed ids of different pieces."""
        if 2 * len(self.known) > self.most:  # what is not met again is forgotten
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, pieces))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = self.older.get(pieces[i])
            if found[i] is not None:
                self.known[pieces[i]] = found[i]
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, ids_of([pieces[i] for i in new]), strict=True):
            found[i] = _packed(ids)
            if len(pieces[i]) <= MAX_CACHED_CHARS:
                self.known[pieces[i]] = found[i]
        return found

    def _other(self, text: str) -> np.ndarray:
        """Ids of a text that is not Latin-1, or holds special tokens."""
        if "<|" in text:  # special tokens may hold anything: the whole text is one piece
            return np.array(next(self._whole([text])), "<u4")
        pieces = [p for p in _GAPS.split(text) if p]
        different = list(dict.fromkeys(pieces))
        ids = dict(zip(different, self._look_up(different, self._whole), strict=True))
        return as_ids(b"".join(map(ids.__getitem__, pieces)))

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a column of texts one after the other, and the bounds of each text's."""
        column = column.cast(pa.string()).fill_null("")
        plain = pc.and_(pc.match_substring_regex(column, _LATIN), pc.invert(pc.match_substring(column, "<|")))
        low = pc.utf8_lower(pc.if_else(plain, column, ""))
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(low, _NO_WORD, r" \1 "))
        coded = pc.dictionary_encode(pc.list_flatten(split))
        ids = self._look_up(coded.dictionary.to_pylist(), self._bare)
        sizes = np.array([len(i) // 4 for i in ids], np.int64)
        starts, flat = np.cumsum(sizes) - sizes, as_ids(b"".join(ids))
        piece = coded.indices.to_numpy()
        own = sizes[piece]
        ends = np.concatenate([[0], np.cumsum(own)])
        taken = np.repeat(starts[piece] - ends[:-1], own) + np.arange(ends[-1])
        out, bounds = flat[taken], ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        others = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        if not len(others):
            return out, bounds
        texts = np.split(out, bounds[1:-1])
        for i in others:
            texts[i] = self._other(column[i].as_py())
        return np.concatenate(texts), np.concatenate([[0], np.cumsum([len(x) for x in texts])])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        ids, bounds = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker and file, shared by its tasks."""
    return WordTokenizer(path)


class ByteTokenizer:
    """Byte-pair encoder of a rank file, for texts of any kind.

    The matcher of the splitting pattern keeps a stack entry for each character of a run of
    white space and fails beyond a million. Such a run is cut out as the pattern would: all of
    it is one piece, but for a last character that a word follows.
    """

    def __init__(self, path: str):
        import tiktoken

        ranks = {}
        with open(path, "rb") as lines:
            for line in lines:
                token, number = line.split()
                ranks[base64.b64decode(token)] = int(number)
        self._split = tiktoken.Encoding("split", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self._piece = tiktoken.Encoding("piece", pat_str="(?s:.+)", mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary

    def encode(self, text: str) -> list[int]:
        if len(text) < LONG_GAP:
            return self._split(text)
        ids, start = [], 0
        for gap in _LONG_GAP.finditer(text):
            end = gap.end() if gap.end() == len(text) else gap.end() - 1
            ids += self._split(text[start : gap.start()]) + self._piece(text[gap.start() : end])
            start = end
        return ids + self._split(text[start:])


@lru_cache(maxsize=2)
def byte_tokenizer(path: str) -> ByteTokenizer:
    """One per worker and file."""
    return ByteTokenizer(path)


def as_ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4")
