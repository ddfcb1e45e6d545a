"""Token ids of whole texts with a public tokenizer file, word by word: a portion's different words are encoded once."""

from __future__ import annotations

import json
import os
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import claim

assert sys.byteorder == "little" and array("I").itemsize == 4
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

#: What may end a word without being a letter or digit to any pre-tokenizer (no apostrophe).
ENDS = ".,;:!?*&%$#()[]{}|/\\\"-_=+~"
MARK, LOT = "|", 512  # what stands between words that are encoded together, and how many are


class _Lists:
    """Lists of 32-bit ids, end to end."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes
        self.starts = np.cumsum(sizes) - sizes

    def take(self, at: np.ndarray) -> _Lists:
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return _Lists(self.flat[np.arange(total) + np.repeat(self.starts[at] - ends + sizes, sizes)], sizes)

    def __add__(self, other: _Lists) -> _Lists:
        return _Lists(np.concatenate([self.flat, other.flat]), np.concatenate([self.sizes, other.sizes]))


def _no_lists() -> _Lists:
    return _Lists(np.empty(0, np.uint32), np.empty(0, np.int64))


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes; those of the first `limit` different words are remembered.

    For tokenizers whose pre-tokenizer drops white space and never looks across it, and that end a
    piece where a letter is followed by punctuation; split_words() tells if a tokenizer file is of that
    kind, and others encode each text as a whole.
    """

    limit = 400_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = split_words(self.tokenizer)
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None  # an id that no text without the mark has
        self.clear()

    def clear(self) -> None:
        self.known, self.ids = pa.array([], pa.string()), _no_lists()

    def encode(self, text: bytes) -> bytes:
        return array("I", self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()

    def _encoded(self, words: pa.Array) -> _Lists:
        """Ids of different words: many as one text, with marks between them, as the tokenizer's cost for each text is high."""
        marked = pc.match_substring(words, MARK)
        flat = array("I")
        joined = words.filter(pc.invert(marked)) if self.mark is not None else words.slice(0, 0)
        for i in range(0, len(joined), 16 * LOT):
            lots = [joined.slice(j, LOT).to_pylist() for j in range(i, min(len(joined), i + 16 * LOT), LOT)]
            for e in self.tokenizer.encode_batch_fast([f" {MARK} ".join([*lot, ""]) for lot in lots], add_special_tokens=False):
                flat.extend(e.ids)
        flat = np.frombuffer(flat, np.uint32)
        ends = np.flatnonzero(flat == self.mark) if self.mark is not None else np.empty(0, np.int64)
        plain = _Lists(flat[flat != self.mark], np.diff(np.concatenate([[-1], ends])) - 1)
        if len(plain.sizes) != len(joined):
            raise ValueError("the tokenizer does not keep words apart")
        rest = words.filter(marked) if self.mark is not None else words
        each = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(rest.to_pylist(), add_special_tokens=False)]
        if not each:
            return plain
        both = plain + _Lists(np.concatenate(each), np.array([len(x) for x in each], np.int64))
        odd = marked.to_numpy(zero_copy_only=False) if self.mark is not None else np.ones(len(words), bool)
        at = np.empty(len(words), np.int64)
        at[~odd], at[odd] = np.arange(len(plain.sizes)), len(plain.sizes) + np.arange(len(each))
        return both.take(at)

    def _of_words(self, words: pa.Array) -> _Lists:
        """Ids of different words, with those that are known looked up."""
        at = pc.index_in(words, value_set=self.known)
        fresh = words.filter(at.is_null())
        if not len(fresh):
            return self.ids.take(at.to_numpy())
        made = self._encoded(fresh)
        room = min(len(fresh), max(0, self.limit - len(self.known)))
        place = at.to_numpy(zero_copy_only=False)
        missing = np.isnan(place) if place.dtype.kind == "f" else np.zeros(len(place), bool)
        both = np.where(missing, 0, place).astype(np.int64)
        both[missing] = len(self.known) + np.arange(len(fresh))
        out = (self.ids + made).take(both)
        if room:
            self.known = pa.concat_arrays([self.known, fresh.slice(0, room)])
            self.ids = self.ids + made.take(np.arange(room))
        return out

    def _portion(self, texts: pa.Array) -> Iterator[bytes]:
        # special tokens are found before a text is lower-cased
        special = pc.match_substring(texts, "<|")
        lower = pc.if_else(special, texts, pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(lower)
        coded = lists.flatten().dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        # a word with punctuation at its end is what is before and after
        cores = pc.utf8_rtrim(words, characters=ENDS)
        cut = pc.and_(pc.and_(pc.utf8_is_alpha(cores), pc.less(pc.binary_length(cores), pc.binary_length(words))), pc.greater(pc.binary_length(cores), 0))
        cores = pc.if_else(cut, cores, words)
        tails = _after(words, cores)
        parts = pa.concat_arrays([cores, tails]).dictionary_encode()
        of_part = self._of_words(parts.dictionary)
        both = parts.indices.to_numpy(zero_copy_only=False)
        first, second = of_part.take(both[: len(words)]), of_part.take(both[len(words) :])
        # the ids of a word's parts, one after the other
        sizes = first.sizes + second.sizes
        starts = np.cumsum(sizes) - sizes
        flat = np.empty(int(sizes.sum()), np.uint32)
        for part, shift in ((first, 0), (second, first.sizes)):
            flat[np.arange(len(part.flat)) + np.repeat(starts + shift - part.starts, part.sizes)] = part.flat
        of_word = _Lists(flat, sizes)
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        for r in range(len(texts)):
            yield of_word.take(at[ends[r] : ends[r + 1]]).flat.tobytes()

    def documents(self, texts: pa.Array, at_once: int = 1 << 23) -> Iterator[bytes]:
        """Ids of whole texts (an Arrow array of strings), equal to the tokenizer's own; texts are taken in portions of some MB."""
        if not self.by_word:
            for t in texts:
                yield self.encode(t.as_py().encode())
            return
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + at_once)))
            yield from self._portion(texts.slice(at, end - at).cast(pa.string()))
            at = end

    def document(self, text: bytes) -> bytes:
        return next(self.documents(pa.array([text.decode()])))


def _after(words: pa.Array, cores: pa.Array) -> pa.Array:
    """What follows each core in its word."""
    w, c = pc.binary_length(words).to_numpy(), pc.binary_length(cores).to_numpy()
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    starts = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words)].astype(np.int64) + c
    tails = _Lists(data, w)
    tails.starts, tails.sizes = starts, (w - c).astype(np.int64)
    got = tails.take(np.arange(len(words)))
    offsets = np.concatenate([[0], np.cumsum(got.sizes)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(words), pa.py_buffer(offsets), pa.py_buffer(got.flat))


def split_words(tokenizer) -> bool:
    """Whether the tokenizer lower-cases, drops white space and treats words apart from each other."""
    spec = json.loads(tokenizer.to_str())
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in pre] == ["Split", "ByteLevel"] and pre[0]["invert"] and pre[0]["behavior"] == "Removed" and "[^\\s\\p{L}\\p{N}]+" in pre[0]["pattern"]["Regex"] and spec.get("post_processor") is None


_of: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of a Python worker, loaded once."""
    claim(_of)
    if path not in _of:
        _of[path] = WordIds(path)
    return _of[path]
