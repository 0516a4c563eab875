"""Byte-level BPE encoding and decoding with a lexicon of frequent words.

A first pass counts the words (pre-tokens) of all documents. The most frequent, at most `lexicon` of them, are encoded
and compiled on the driver into a minimal acyclic transducer: equal suffixes share states, and the outputs along a
word's arcs add up to its number, which selects its ids. The arrays are one file's worth of a few MB (bounded by `lexicon`), broadcast, and
memory-mapped by each worker. Words outside the lexicon are merged exactly, by rank, all words of a batch together.

Text is cut before each space first, since word boundaries always lie there; pieces repeat, so each is handled once a
worker, and known ones are found by 64-bit hash, all pieces of a slice of text together. Ids, their decimal numbers and the decoded bytes
are gathered from tables for whole slices. Texts with other runs of white space next to spaces, white space beyond ASCII or special tokens are cut by the full pattern.
Null texts are empty: no ids, and they decode to nothing. Ties in frequency at the lexicon's edge leave all tied words out. Nothing is cut short; equal texts give equal ids.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import itertools
import json
import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, Table, documents, spread, text_slices, word_hashes, written
from .vocabularies import tokenizer_path

LEXICON = 1 << 16
MEMO = 1 << 20
LONG = 256
#: Fixed value: the pattern by which byte-level BPE splits text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others by the letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Merges:
    """The vocabulary of a byte-level BPE file, and exact merging. In files that mark the ends of words, a word's last byte has a letter of its own."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.n = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * self.n
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.byte_id = np.array([vocab[c] for c in byte_letters()], np.int64)
        end = spec["model"].get("end_of_word_suffix") or ""
        self.last_id = np.array([vocab[c + end] for c in byte_letters()], np.int64)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.n + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)  # a letter at the end keeps its mark
        self.pattern = None

    def words(self, text: str) -> list[str]:
        if self.pattern is None:
            import regex

            self.pattern = regex.compile(PATTERN)
        return self.pattern.findall(text)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word. Each round merges every word's best pair, so short words take as many rounds as the longest merge."""
        out: list = [None] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= LONG]
        for i in set(range(len(words))) - set(short):
            out[i] = self.merge_long(words[i])
        lengths = np.array([len(words[i]) for i in short], np.int64)
        raw = np.frombuffer(b"".join(words[i] for i in short), np.uint8)
        sym, ends = self.byte_id[raw], np.cumsum(lengths[lengths > 0]) - 1
        sym[ends] = self.last_id[raw[ends]]
        live = np.array(short, np.int64)
        live, lengths = live[lengths > 0], lengths[lengths > 0]
        for i in short:
            if not words[i]:
                out[i] = np.zeros(0, np.int64)
        word = np.repeat(np.arange(len(live)), lengths)
        rank = np.full(len(sym), NONE)
        rank[:-1] = np.where(word[1:] == word[:-1], self.rank(sym[:-1], sym[1:]), NONE)
        while len(live):
            starts = np.cumsum(lengths) - lengths
            best = np.minimum.reduceat(rank, starts)
            done = best == NONE
            if done.any():
                for k in np.flatnonzero(done):
                    out[live[k]] = sym[starts[k] : starts[k] + lengths[k]]
                stay = ~done[word]
                sym, rank = sym[stay], rank[stay]
                live, lengths, best = live[~done], lengths[~done], best[~done]
                word = np.repeat(np.arange(len(live)), lengths)
                if not len(live):
                    break
            hit = np.flatnonzero(rank == best[word])
            run = np.flatnonzero(np.concatenate([[True], np.diff(hit) != 1]))
            hit = hit[(np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))) % 2 == 0]
            sym[hit] = self.merged[rank[hit]]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            lengths -= np.bincount(word[hit], minlength=len(live))
            at = hit - np.arange(len(hit))
            sym, rank, word = sym[stay], rank[stay], word[stay]
            again = np.unique(np.concatenate([at, at[at > 0] - 1]))
            after = np.minimum(again + 1, len(sym) - 1)
            rank[again] = np.where((word[after] == word[again]) & (after > again), self.rank(sym[again], sym[after]), NONE)
        return out

    def merge_long(self, word: bytes) -> np.ndarray:
        """As merge(), for one long word, in n log n steps."""
        sym = [*self.byte_id[np.frombuffer(word[:-1], np.uint8)].tolist(), int(self.last_id[word[-1]])]
        after, before = [*range(1, len(sym)), -1], [-1, *range(len(sym) - 1)]
        ranks = self.rank(np.array(sym[:-1]), np.array(sym[1:]))
        heap = [(int(r), i, sym[i], sym[i + 1]) for i, r in enumerate(ranks) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j], after[i] = int(self.merged[r]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (found := int(self.rank(np.array([sym[left]]), np.array([sym[right]]))[0])) != NONE:
                    heapq.heappush(heap, (found, left, sym[left], sym[right]))
        return np.array([s for s in sym if s >= 0], np.int64)


def compile_lexicon(words: list[bytes], ids: list[np.ndarray]) -> bytes:
    """The minimal acyclic transducer of distinct words in ascending order, as an .npy stream: arcs by (state, byte), their targets and outputs, final states, ids."""
    states: list[dict] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path, last = [0], b""

    def freeze(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            key = (final[state], *states[state].items())
            known = register.setdefault(key, state)
            if known != state:
                states[path[-1]][last[len(path) - 1]] = known
                states[state] = {}

    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        freeze(same)
        for b in word[same:]:
            states.append({})
            final.append(False)
            states[path[-1]][b] = len(states) - 1
            path.append(len(states) - 1)
        final[path[-1]] = True
        last = word
    freeze(0)

    below: dict[int, int] = {}  # words that start from a state
    todo = [0]
    while todo:
        s = todo[-1]
        if missing := [t for t in states[s].values() if t not in below]:
            todo += missing
            continue
        below[s] = int(final[s]) + sum(below[t] for t in states[s].values())
        todo.pop()
    number = {s: i for i, s in enumerate(sorted(below))}
    arcs = []
    for s in below:
        out = int(final[s])
        for b, t in sorted(states[s].items()):
            arcs.append((number[s] * 256 + b, number[t], out))
            out += below[t]
    arcs.sort()
    table = np.array(arcs, np.int64).reshape(-1, 3)
    counts = np.array([len(x) for x in ids], np.int64)
    held = io.BytesIO()
    for x in (table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32), np.array([final[s] for s in sorted(below)], bool), np.cumsum(counts) - counts, counts, np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int32)):
        np.save(held, x)
    return held.getvalue()


class Lexicon:
    """The compiled transducer, memory-mapped."""

    def __init__(self, image: bytes):
        at, where = tempfile.mkstemp(prefix="lexicon-")
        with os.fdopen(at, "wb") as f:
            f.write(image)
        whole = np.memmap(where, np.uint8, "r")
        os.unlink(where)  # the mapping keeps it until the worker ends
        parts, offset, head = [], 0, io.BytesIO(image)
        for _ in range(7):
            head.seek(offset)
            version = np.lib.format.read_magic(head)
            shape, _, kind = np.lib.format.read_array_header_1_0(head) if version == (1, 0) else np.lib.format.read_array_header_2_0(head)
            start = head.tell()
            offset = start + int(np.prod(shape)) * kind.itemsize
            parts.append(whole[start:offset].view(kind).reshape(shape))
        self.arcs, self.target, self.out, self.final, self.starts, self.counts, self.ids = parts

    def find(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, or -1: all words walk the automaton together, a byte a step."""
        lengths = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(words), np.uint8)
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        live, step = np.flatnonzero(lengths > 0), 0
        fits = np.ones(len(words), bool)
        while len(live) and len(self.arcs):
            key = state[live] * 256 + data[starts[live] + step]
            at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            known = self.arcs[at] == key
            fits[live[~known]] = False
            live, at = live[known], at[known]
            state[live] = self.target[at]
            number[live] += self.out[at]
            step += 1
            live = live[lengths[live] > step]
        if not len(self.arcs):
            return np.full(len(words), -1)
        return np.where(fits & (lengths > 0) & self.final[state], number, -1)


_MERGES: dict[str, Merges] = {}


def merges_of(path: str) -> Merges:
    if path not in _MERGES:
        _MERGES[path] = Merges(path)
    return _MERGES[path]


#: UTF-8 of white space beyond ASCII, by its first two bytes and the range of the third.
_WIDE = ((0xC2, 0x85, None), (0xC2, 0xA0, None), (0xE1, 0x9A, (0x80, 0x80)), (0xE2, 0x80, (0x80, 0x8A)), (0xE2, 0x80, (0xA8, 0xA9)), (0xE2, 0x80, (0xAF, 0xAF)), (0xE2, 0x81, (0x9F, 0x9F)), (0xE3, 0x80, (0x80, 0x80)))


def uneven_rows(data: np.ndarray, off: np.ndarray, special: list[bytes]) -> np.ndarray:
    """Rows where a cut before each space could be wrong: a space between other white space, or at the end after some; white space beyond ASCII; special tokens."""
    at = []
    after = np.concatenate([data[1:], [0, 0]]).astype(np.uint8)
    first_of_row = np.zeros(len(data) + 2, bool)
    first_of_row[off] = True
    spaced = SPACE[data[:-1]] & (data[1:] == 32) & ~first_of_row[1 : len(data)] if len(data) else np.zeros(0, bool)
    at.append(np.flatnonzero(spaced & (SPACE[after[1 : len(data)]] | first_of_row[2 : len(data) + 1])))
    at.append(np.flatnonzero((data >= 0x1C) & (data <= 0x1F)))
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    second, third = after[lead], after[np.minimum(lead + 1, len(after) - 1)]
    for one, two, three in _WIDE:
        hit = (data[lead] == one) & (second == two)
        at.append(lead[hit if three is None else hit & (third >= three[0]) & (third <= three[1])])
    raw = data.tobytes() if special else b""
    for token in special:
        k = raw.find(token)
        while k >= 0:
            at.append(np.array([k]))
            k = raw.find(token, k + 1)
    rows = np.zeros(len(off) - 1, bool)
    rows[np.searchsorted(off, np.concatenate(at), side="right") - 1] = True
    return rows


def piece_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces: a row is cut before each space. And how many each row has."""
    cut = data == 32
    cut[off[:-1][off[:-1] < off[1:]]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(data))[: len(starts)], np.diff(np.searchsorted(starts, off))


class Pieces:
    """Numbers of pieces in the order in which they come; learn(strings) is told the new ones."""

    def __init__(self, learn):
        self.learn = learn
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def number(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = word_hashes(data, starts, ends)
        at = np.searchsorted(self.keys, h)
        miss = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] != h) if len(self.keys) else np.arange(len(h))
        if len(miss):
            new, example = np.unique(h[miss], return_index=True)
            example = miss[example]
            self.learn([data[a:b].tobytes().decode() for a, b in zip(starts[example].tolist(), ends[example].tolist(), strict=True)])
            self.numbers = np.insert(self.numbers, place := np.searchsorted(self.keys, new), len(self.numbers) + np.arange(len(new)))
            self.keys = np.insert(self.keys, place, new)
            at = np.searchsorted(self.keys, h)
        return self.numbers[at]


class Strings:
    """Byte strings by number: of many numbers, all bytes and how many each has."""

    def __init__(self, strings: list[bytes]):
        self.counts = np.array([len(x) for x in strings], np.int64)
        self.starts, self.flat = np.cumsum(self.counts) - self.counts, np.frombuffer(b"".join(strings), np.uint8)

    def __call__(self, numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
        counts = self.counts[numbers]
        return self.flat[spread(self.starts[numbers], counts)].tobytes(), counts


class Encoder:
    def __init__(self, path: str, image: bytes):
        self.bpe, self.lexicon = merges_of(path), Lexicon(image)
        self.decimal, self.decoded = Strings([b"%d," % i for i in range(self.bpe.n)]), Strings(self.bpe.bytes_of)
        self.special = re.compile("(" + "|".join(map(re.escape, self.bpe.special)) + ")") if self.bpe.special else None
        self.forget()

    def forget(self) -> None:
        self.words, self.table, self.pieces = Table(), Table(), Pieces(self.learn_pieces)

    def learn_words(self) -> None:
        if not self.words.new:
            return
        words = [w.encode() for w in self.words.new]
        number = self.lexicon.find(words)
        unseen = np.flatnonzero(number < 0)
        merged = self.bpe.merge([words[i] for i in unseen])
        counts = self.lexicon.counts[np.maximum(number, 0)] if len(self.lexicon.counts) else np.zeros(len(words), np.int64)
        counts = np.array(counts)
        counts[unseen] = [len(m) for m in merged]
        flat = np.zeros(int(counts.sum()), np.int32)
        ends = np.cumsum(counts)
        for_known = np.flatnonzero(number >= 0)
        if len(for_known):
            flat[spread(ends[for_known] - counts[for_known], counts[for_known])] = self.lexicon.ids[spread(self.lexicon.starts[number[for_known]], counts[for_known])]
        if len(unseen):
            flat[spread(ends[unseen] - counts[unseen], counts[unseen])] = np.concatenate(merged)
        self.words.learn(flat, counts)

    def learn_pieces(self, new: list[str]) -> None:
        split = [self.bpe.words(p) for p in new]
        at = np.fromiter((self.words[w] for ws in split for w in ws), np.int64)
        self.learn_words()
        n_words = np.array([len(ws) for ws in split], np.int64)
        lengths = np.concatenate([[0], np.cumsum(self.words.counts[at])])
        ends = np.cumsum(n_words)
        self.table.learn(self.words.ids(at), lengths[ends] - lengths[ends - n_words])

    def full(self, text: str) -> np.ndarray:
        """By the full pattern, special tokens apart."""
        parts: list[int] = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.bpe.special:
                parts.append(-self.bpe.special[part])
            else:
                parts += [self.words[w] + 1 for w in self.bpe.words(part)]
        self.learn_words()
        held = [np.array([-p], np.int32) if p <= 0 and -p in self.bpe.special.values() else self.words.ids(np.array([p - 1])) for p in parts]
        return np.concatenate(held) if held else np.zeros(0, np.int32)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows (UTF-8 bytes and offsets), and how many each has."""
        if len(self.words) > MEMO or len(self.pieces.keys) > MEMO:
            self.forget()
        odd = uneven_rows(data, off, [t.encode() for t in self.bpe.special])
        starts, ends, per = piece_spans(data, off)
        if odd.any():
            plain = np.repeat(~odd, per)
            starts, ends, per = starts[plain], ends[plain], np.where(odd, 0, per)
        at = self.pieces.number(data, starts, ends)
        total = np.concatenate([[0], np.cumsum(self.table.counts[at])])
        last = np.cumsum(per)
        counts = total[last] - total[last - per]
        ids = self.table.ids(at)
        if not odd.any():
            return ids, counts
        more = {r: self.full(data[off[r] : off[r + 1]].tobytes().decode()) for r in np.flatnonzero(odd).tolist()}
        begin = np.cumsum(counts)
        parts, done = [], 0
        for r, x in more.items():
            parts += [ids[done : begin[r]], x]
            done, counts[r] = begin[r], len(x)
        return np.concatenate([*parts, ids[done:]]), counts

    def shown(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The ids of each row in decimal, with commas."""
        return [x[:-1] for x in _rows(*self.decimal(ids), counts)]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The text of each row's ids, in UTF-8."""
        out = _rows(*self.decoded(ids), counts)
        for i, x in enumerate(out):
            try:
                x.decode()
            except UnicodeDecodeError:
                out[i] = x.decode(errors="replace").encode()
        return out


def _rows(flat: bytes, sizes: np.ndarray, counts: np.ndarray) -> list[bytes]:
    cuts = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    return [flat[a:b] for a, b in itertools.pairwise(cuts)]


def _count_words(path: str):
    """(word, n) over a partition: pieces are counted first, and only distinct ones are cut into words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = merges_of(path)
        special = [t.encode() for t in bpe.special]
        words, flat, lengths, full = Table(), [], [], Counter()
        counts = np.zeros(0, np.int64)

        def learn(new: list[str]) -> None:
            for piece in new:
                found = [words[w] for w in bpe.words(piece)]
                flat.extend(found)
                lengths.append(len(found))

        def result():
            n = np.bincount(flat, weights=np.repeat(counts, lengths), minlength=len(words)).astype(np.int64)
            n = dict(zip(words, n.tolist(), strict=True))
            for w, k in full.items():
                n[w] = n.get(w, 0) + k
            return pa.record_batch([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

        pieces = Pieces(learn)
        for batch in batches:
            for _, data, off in text_slices(batch, "text"):
                odd = uneven_rows(data, off, special)
                starts, ends, per = piece_spans(data, off)
                plain = np.repeat(~odd, per)
                found = np.bincount(pieces.number(data, starts[plain], ends[plain]), minlength=len(lengths))
                found[: len(counts)] += counts
                counts = found
                for r in np.flatnonzero(odd).tolist():
                    full.update(bpe.words(data[off[r] : off[r + 1]].tobytes().decode()))
                if len(lengths) + len(full) > MEMO:
                    yield result()
                    words, flat, lengths, full, pieces, counts = Table(), [], [], Counter(), Pieces(learn), np.zeros(0, np.int64)
        if lengths or full:
            yield result()

    return run


def build_lexicon(docs: DataFrame, path: str, lexicon: int = LEXICON) -> bytes:
    """The transducer of the most frequent words of all documents."""
    counts = docs.select("text").mapInArrow(_count_words(path), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts.where("n > 1 and octet_length(word) <= 256"), "bpe-words")
    # How many words occur n times or more; the least n with at most `lexicon` of them. One row a distinct count.
    by_count = counts.groupBy("n").agg(F.count("*").alias("words"))
    least = by_count.withColumn("up", F.sum("words").over(Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc()))).where(F.col("up") <= lexicon).agg(F.min("n")).first()[0]
    words = sorted(r.word.encode() for r in counts.where(F.col("n") >= least).select("word").collect()) if least else []
    return compile_lexicon(words, merges_of(path).merge(words))


def encoded(docs: DataFrame, path: str, image: bytes, keep: list[str], finish, schema: str) -> DataFrame:
    """Encodes each text and decodes its ids: finish(encoder, kept column arrays, ids, how many each row has) gives a batch of the schema."""
    held = docs.sparkSession.sparkContext.broadcast(image)  # bounded by the lexicon's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, held.value)
        for batch in batches:
            for rows, data, off in text_slices(batch, "text", 2 << 20):
                ids, counts = encoder.encode(data, off)
                yield finish(encoder, [rows.column(c) for c in keep], ids, counts)

    return docs.select(*keep, "text").mapInArrow(run, schema)


def bpe_documents(docs: DataFrame, path: str | None = None, lexicon: int = LEXICON) -> DataFrame:
    """doc_id, n_tokens, ids (array of int), decoded (the text of the ids)."""
    path = path or tokenizer_path("byte_bpe_50k.json")

    def finish(encoder, kept, ids, counts):
        off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        texts = pa.array(encoder.decode(ids, counts), pa.binary()).cast(pa.string())
        return pa.record_batch([*kept, pa.array(counts), pa.ListArray.from_arrays(pa.array(off), pa.array(ids.astype(np.int32))), texts], names=["doc_id", "n_tokens", "ids", "decoded"])

    return encoded(docs, path, build_lexicon(docs, path, lexicon), ["doc_id"], finish, "doc_id long, n_tokens long, ids array<int>, decoded string")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json")
    sha = lambda strings: pa.array([hashlib.sha256(x).hexdigest() for x in strings])

    def finish(encoder, kept, ids, counts):
        return pa.record_batch([*kept, pa.array(counts), sha(encoder.shown(ids, counts)), sha(encoder.decode(ids, counts))], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded(docs, path, build_lexicon(docs, path), ["doc_id"], finish, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
