"""Ids of whole texts by the tokenizers library, for tokenizers that drop white space and lower-case: each distinct unit is encoded once a worker.

A unit is a word between ASCII white space or, in words of plain characters (printable ASCII without apostrophe and <, letters of
Latin-1), a run of letters, a digit, or a run of others: the tokenizer splits there and looks no further. Units are found and hashed
over whole slices of text at once; only new ones become strings. Known units are a sorted table of 64-bit hashes, some 20 bytes each.
"""

from __future__ import annotations

import os

import numpy as np

from .bpe import Merges
from .common import Lookup, spread, word_hashes, word_spans

#: Units that a worker remembers.
MEMO = 2_000_000
#: Units that go to the library in one text.
BATCH = 500

_OTHER, _LETTER, _DIGIT = 0, 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_CLASS[48:58] = _DIGIT
_ODD = np.ones(256, bool)
_ODD[[9, 10, 11, 12, 13, 32, *(b for b in range(33, 127) if b not in b"'<")]] = False
_SECOND = np.zeros(256, bool)
_SECOND[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True


def units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (lower case in plain words), unit starts, ends, whether each is a whole odd word, and the number of units of each row."""
    starts, ends, counts = word_spans(data, off)
    if not len(starts):
        return data, starts, ends, np.zeros(0, bool), counts
    pair = np.zeros(len(data), bool)
    pair[:-1] = (data[:-1] == 0xC3) & _SECOND[data[1:]]
    second = np.zeros(len(data), bool)
    second[1:] = pair[:-1]
    odd_byte = _ODD[data] & ~pair & ~second
    total = np.concatenate([[0], np.cumsum(odd_byte)])
    odd = total[ends] > total[starts]
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    low[second & (data <= 0x9E)] += 32
    kind = _CLASS[data]
    new = np.zeros(len(data), bool)
    new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    for a, b in zip(starts[odd].tolist(), ends[odd].tolist(), strict=True):
        new[a:b] = False
        low[a:b] = data[a:b]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    new &= np.cumsum(inside[:-1], dtype=np.int8) > 0
    new[starts] = True
    first = np.flatnonzero(new)
    word = np.searchsorted(starts, first, side="right") - 1
    last = ends[word]
    same = word[1:] == word[:-1]
    last[:-1][same] = first[1:][same]
    return low, first, last, odd[word], np.diff(np.searchsorted(first, off))


class UnitIds:
    """own: plain units are merged here, all new ones together, to the library's ids; else by the library itself."""

    def __init__(self, path: str, own: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.size = self.tokenizer.get_vocab_size()
        zero = self.library("0")
        self.between = zero[0] if len(zero) == 1 and len(self.library("a 0 b")) == 3 else None
        self.own = Merges(path) if own and self.between is not None else None
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.table = Lookup(self.keys)
        self.starts, self.counts, self.flat = np.zeros(0, np.int32), np.zeros(0, np.int16), np.zeros(0, np.int32)

    def library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, keys: np.ndarray, texts: list[str], alone: np.ndarray) -> None:
        """Encodes new units: plain ones many at a time with zeros between, which no other plain unit holds."""
        got_ids, got_counts, got_keys = [], [], []
        plain = np.flatnonzero(~alone) if self.between is not None else np.zeros(0, np.int64)
        if self.own is not None and len(plain):
            merged = self.own.merge([texts[i].encode() for i in plain])
            got_ids.append(np.concatenate(merged).astype(np.int32))
            got_counts.append(np.array([len(m) for m in merged]))
            got_keys.append(keys[plain])
        for a in range(0, len(plain) if self.own is None else 0, BATCH):
            part = plain[a : a + BATCH]
            ids = np.array(self.library(" 0 ".join([texts[i] for i in part])), np.int32)
            cuts = np.flatnonzero(ids == self.between)
            got_counts.append(np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1)
            got_ids.append(ids[ids != self.between])
            got_keys.append(keys[part])
        for i in np.setdiff1d(np.arange(len(texts)), plain):
            ids = np.array(self.library(texts[i]), np.int32)
            got_ids.append(ids)
            got_counts.append(np.array([len(ids)]))
            got_keys.append(keys[i : i + 1])
        counts = np.concatenate(got_counts)
        starts = len(self.flat) + np.cumsum(counts) - counts
        order = np.argsort(merged := np.concatenate([self.keys, *got_keys]), kind="stable")
        self.keys = merged[order]
        self.table = Lookup(self.keys)
        self.starts = np.concatenate([self.starts, starts.astype(np.int32)])[order]
        self.counts = np.concatenate([self.counts, counts.astype(np.int32)])[order]
        self.flat = np.concatenate([self.flat, *got_ids])

    def encode(self, data: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows (bytes and offsets), each with the end id, and the number of each."""
        if len(self.keys) > MEMO:
            self.forget()
        low, first, last, odd, per_row = units(data, off)
        h = word_hashes(low, first, last) ^ np.where(odd, np.uint64(0x5DEECE66D), np.uint64(0))
        place, known = self.table(h)
        missing = np.flatnonzero(~known)
        if len(missing):
            new, example = np.unique(h[missing], return_index=True)
            where = missing[example]
            raw = low.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(first[where].tolist(), last[where].tolist(), strict=True)]
            self.learn(new, texts, odd[where] | (_CLASS[low[first[where]]] == _DIGIT))
            place, _ = self.table(h)
        lengths = self.counts[place].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(per_row)
        counts = total[ends] - total[ends - per_row] + 1
        out = np.full(int(counts.sum()), end_id, np.uint32)
        inner = np.ones(len(out), bool)
        inner[np.cumsum(counts) - 1] = False
        out[inner] = self.flat[spread(self.starts[place].astype(np.int64), lengths)]
        return out, counts


_KNOWN: dict[tuple[str, bool], UnitIds] = {}


def unit_ids(path: str, own: bool = False) -> UnitIds:
    """The worker's encoder, which later tasks use again."""
    if (path, own) not in _KNOWN:
        _KNOWN[path, own] = UnitIds(path, own)
    return _KNOWN[path, own]
