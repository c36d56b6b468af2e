"""Byte-level BPE by a transducer of frequent words, with exact merges for the rest.

The words of all texts are counted by bounded, mergeable summaries per task. The most
frequent ones are encoded once and compiled into a minimal acyclic automaton whose
transitions add up to a word's number and, with it, its token ids. The arrays are one
file that Spark hands to every executor, where its workers map it into memory. A word
that the automaton lacks is merged pair by pair, many words at a time.

Results do not depend on which words the automaton holds. Words are split as the
vocabulary's own pattern does, over the bytes of whole blocks at once; character classes are
those of this Python's Unicode tables. A special token's text in a document is that
token, as the vocabulary's library has it.

NULL and empty texts have no tokens and decode to the empty text. Repeated rows are encoded
each on its own; other columns pass through ``encode`` unless they bear a result's name, in
which case the result replaces them.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import tempfile
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm.store import stored
from strata.llm.textops import map_texts, ragged, text_blocks

#: Words that the automaton holds at most, and words a task counts at a time.
LEXICON_WORDS = 60_000
COUNTED_WORDS = 100_000
#: Words up to so many bytes are merged many at a time.
BATCH_WORD_BYTES = 200
_NONE = np.int64(1) << 40
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 4
#: Fixed: white space beyond ASCII.
_WIDE_SPACES = {0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
#: Fixed: letters that an apostrophe takes with it.
_SHORT_ENDINGS, _LONG_ENDINGS = b"stmd", (b"re", b"ve", b"ll")


# ---------------------------------------------------------------- vocabulary


@dataclass
class Vocabulary:
    """The tables of a byte-level BPE file, small enough to broadcast."""

    byte_ids: np.ndarray  # token id of each byte
    pair_keys: np.ndarray  # sorted (left << 20 | right)
    pair_ranks: np.ndarray
    pair_ids: np.ndarray
    token_bytes: np.ndarray  # all tokens' bytes in a row
    token_offsets: np.ndarray
    specials: dict[bytes, int]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``_NONE`` if absent) and merged id of each pair."""
        if not len(self.pair_keys):
            return np.full(len(left), _NONE), np.zeros(len(left), np.int64)
        keys = (left << 20) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        known = self.pair_keys[at] == keys
        return np.where(known, self.pair_ranks[at], _NONE), self.pair_ids[at]

    def digits(self) -> tuple[np.ndarray, np.ndarray]:
        """Each id as decimal digits and a comma, and how many of these bytes count."""
        texts = [f"{i},".encode() for i in range(len(self.token_offsets) - 1)]
        return ragged_bytes(texts)


def ragged_bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def _shown_bytes() -> dict[str, int]:
    """Byte of each character that stands for a byte in the file: printable ones for
    themselves, the others in order from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def load_vocabulary(path: str) -> Vocabulary:
    """Read a tokenizer file; only byte-level BPE without normaliser is accepted."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    split = parts["pre_tokenizer"]
    if parts["model"]["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or parts["normalizer"]:
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    shown = _shown_bytes()
    vocab = parts["model"]["vocab"]
    specials = {t["content"].encode(): t["id"] for t in parts["added_tokens"]}
    tokens = [b""] * (max([*vocab.values(), *specials.values()]) + 1)
    for text, number in vocab.items():
        tokens[number] = bytes(shown[c] for c in text)
    for text, number in specials.items():
        tokens[number] = text
    byte_ids = np.zeros(256, np.int64)
    for char, byte in shown.items():
        byte_ids[byte] = vocab[char]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in parts["model"]["merges"]]
    keys = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], np.int64)
    order = np.argsort(keys)
    ids = np.array([vocab[a + b] for a, b in pairs], np.int64)
    blob, offsets = ragged_bytes(tokens)
    return Vocabulary(byte_ids, keys[order], order.astype(np.int64), ids[order], blob, offsets, specials)


# ---------------------------------------------------------------- words


@functools.lru_cache(maxsize=1 << 16)
def _class_of(point: int) -> int:
    if point in _WIDE_SPACES:
        return _SPACE
    kind = unicodedata.category(chr(point))[0] if point < 0x110000 else "X"
    return {"L": _LETTER, "N": _NUMBER}.get(kind, _OTHER)


_ASCII = np.array(
    [_SPACE if 9 <= b <= 13 or b == 32 else _NUMBER if 48 <= b <= 57 else _LETTER if 65 <= b <= 90 or 97 <= b <= 122 else _OTHER for b in range(256)],
    np.uint8,
)


def byte_classes(data: np.ndarray) -> np.ndarray:
    """Letter, number, space or other: of each byte's character."""
    classes = _ASCII[data]
    leads = np.flatnonzero(data >= 0xC0)
    if len(leads):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        first = padded[leads].astype(np.int64)
        tail = [(padded[leads + k] & 0x3F).astype(np.int64) for k in (1, 2, 3)]
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        points = np.choose(
            size - 2,
            [
                (first & 0x1F) << 6 | tail[0],
                (first & 0x0F) << 12 | tail[0] << 6 | tail[1],
                (first & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2],
            ],
        )
        seen, back = np.unique(points, return_inverse=True)
        kinds = np.array([_class_of(int(p)) for p in seen], np.uint8)[back]
        for k in range(4):
            at = (leads + k)[(size > k) & (leads + k < len(data))]
            classes[at] = kinds[(size > k) & (leads + k < len(data))]
    return classes


def split_words(data: np.ndarray, offsets: np.ndarray, specials: dict[bytes, int]) -> np.ndarray:
    """First byte of each word of a block; words lie end to end.

    Runs of one class are words. A blank goes with the run after it, an earlier rest
    of white space is a word of its own, and an apostrophe takes an ending with it.
    """
    size = len(data)
    if not size:
        return np.zeros(0, np.int64)
    cuts = [offsets]
    raw = data.tobytes() if specials else b""
    taken = []
    for text in specials:
        at = raw.find(text)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, "right")) - 1
            if at + len(text) <= offsets[row + 1]:
                taken.append((at, at + len(text)))
                at = raw.find(text, at + len(text))
            else:
                at = raw.find(text, at + 1)
    if taken:
        cuts.append(np.array(taken).ravel())
    stops = np.unique(np.concatenate(cuts))
    is_stop = np.zeros(size + 1, bool)
    is_stop[stops] = True
    is_stop[size] = True

    classes = byte_classes(data)
    begins = is_stop[:size].copy()
    begins[1:] |= classes[1:] != classes[:-1]
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], size)
    kinds = classes[starts]

    space = (kinds == _SPACE) & ~is_stop[ends]
    space_ends = ends[space]
    blank = data[space_ends - 1] == 32
    begins[space_ends[blank]] = False
    begins[space_ends[blank] - 1] = True
    last = space_ends[~blank] - 1
    for _ in range(3):
        last = np.where((data[last] & 0xC0) == 0x80, last - 1, last)
    begins[last] = True

    mark = np.flatnonzero((data[starts] == 39) & (ends - starts == 1) & ~is_stop[ends])
    mark = mark[mark + 1 < len(starts)]
    mark = mark[(kinds[mark + 1] == _LETTER) & begins[starts[mark]]]
    for m in mark:
        at, end = int(starts[m]) + 1, int(ends[m + 1])
        ending = data[at : min(at + 2, end)].tobytes()
        taken_bytes = 1 if ending[:1] and ending[:1] in _SHORT_ENDINGS else 2 if ending in _LONG_ENDINGS else 0
        if taken_bytes:
            begins[at] = False
            if at + taken_bytes < end:
                begins[at + taken_bytes] = True
    for a, b in taken:
        begins[a + 1 : b] = False
    return np.flatnonzero(begins)


# ---------------------------------------------------------------- merges


def merge_one(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """The token ids of one word of any length, lowest rank first from a heap."""
    ids = [int(vocabulary.byte_ids[b]) for b in word]
    after = list(range(1, len(ids))) + [-1]
    before = list(range(-1, len(ids) - 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(places: list[int]) -> None:
        if places:
            ranks, merged = vocabulary.look_up(np.array([ids[p] for p in places]), np.array([ids[after[p]] for p in places]))
            for p, rank, new in zip(places, ranks.tolist(), merged.tolist()):
                if rank < _NONE:
                    heapq.heappush(heap, (rank, p, ids[p], ids[after[p]], new))

    offer(list(range(len(ids) - 1)))
    while heap:
        _, p, left, right, new = heapq.heappop(heap)
        q = after[p]
        if ids[p] != left or q < 0 or ids[q] != right:
            continue
        ids[p], ids[q] = new, -1
        after[p] = after[q]
        if after[p] >= 0:
            before[after[p]] = p
        offer([x for x in (before[p], p) if x >= 0 and after[x] >= 0])
    return [i for i in ids if i >= 0]


_PLACE_BITS = 22
_RUN_BYTES = 1 << (_PLACE_BITS - 1)


def same_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each set of equal words, and for each word which of these it equals.

    Words follow each other without a gap; their bytes are compared, not only hashes.
    """
    cuts = np.append(starts, ends[-1:]).astype(np.int64)
    buffers = [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))]
    codes = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode().indices.to_numpy()
    # codes are given out in the order of first words
    first = np.flatnonzero(codes > np.append(-1, np.maximum.accumulate(codes)[:-1]))
    return first, codes


def merge_many(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of many words, one after another, and each word's number of ids.

    Each round merges the leftmost pair of lowest rank in every word that still has one.
    Places take ``_PLACE_BITS`` bits beside the rank, so words are merged in runs of fewer bytes.
    """
    sizes = ends - starts
    run = np.cumsum(np.where(sizes <= BATCH_WORD_BYTES, sizes, 0)) // _RUN_BYTES
    if len(run) and run[-1] > run[0]:
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(run)]
        parts = [merge_many(data, starts[a:b], ends[a:b], vocabulary) for a, b in zip(cuts, cuts[1:])]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    long = np.flatnonzero(sizes > BATCH_WORD_BYTES)
    words = np.flatnonzero((sizes <= BATCH_WORD_BYTES) & (sizes > 0))
    owner = np.repeat(words, sizes[words])
    ids = vocabulary.byte_ids[data[ragged(starts[words], sizes[words])]]
    done_owner, done_ids = [], []
    for w in long:
        merged = merge_one(data[starts[w] : ends[w]].tobytes(), vocabulary)
        done_owner.append(np.full(len(merged), w))
        done_ids.append(np.array(merged, np.int64))
    ranks = np.full(len(ids), _NONE)
    new = np.zeros(len(ids), np.int64)
    inner = np.flatnonzero(owner[:-1] == owner[1:])
    ranks[inner], new[inner] = vocabulary.look_up(ids[inner], ids[inner + 1])
    while len(ids):
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        best = np.minimum.reduceat((ranks << _PLACE_BITS) | np.arange(len(ids)), heads)
        open_ = best < (_NONE << _PLACE_BITS)
        if not open_.all():
            counts = np.diff(np.append(heads, len(ids)))
            live = np.repeat(open_, counts)
            done_owner.append(owner[~live])
            done_ids.append(ids[~live])
            kept = np.cumsum(live) - 1
            best = best[open_]
            places = kept[best & ((1 << _PLACE_BITS) - 1)]
            owner, ids, ranks, new = owner[live], ids[live], ranks[live], new[live]
        else:
            places = best & ((1 << _PLACE_BITS) - 1)
        if not len(ids):
            break
        ids[places] = new[places]
        keep = np.ones(len(ids), bool)
        keep[places + 1] = False
        moved = np.cumsum(keep) - 1
        places = moved[places]
        owner, ids, ranks, new = owner[keep], ids[keep], ranks[keep], new[keep]
        touched = np.zeros(len(ids), bool)
        touched[places] = touched[places[places > 0] - 1] = True
        fresh = np.flatnonzero(touched)
        paired = np.zeros(len(fresh), bool)
        inside = fresh + 1 < len(ids)
        paired[inside] = owner[fresh[inside]] == owner[fresh[inside] + 1]
        ranks[fresh] = _NONE
        at = fresh[paired]
        ranks[at], new[at] = vocabulary.look_up(ids[at], ids[at + 1])
    if not done_owner:
        return np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
    owner, ids = np.concatenate(done_owner), np.concatenate(done_ids)
    order = np.argsort(owner, kind="stable")
    return ids[order], np.bincount(owner, minlength=len(starts))


# ---------------------------------------------------------------- transducer


@dataclass
class Transducer:
    """A minimal acyclic automaton; the words' numbers follow their byte order."""

    keys: np.ndarray  # sorted (state << 8 | byte)
    targets: np.ndarray
    adds: np.ndarray  # words that come before this branch
    finals: np.ndarray
    root: np.ndarray
    ids: np.ndarray
    id_offsets: np.ndarray

    NAMES = ("keys", "targets", "adds", "finals", "root", "ids", "id_offsets")

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words it does not hold."""
        found = np.full(len(starts), -1, np.int64)
        if not len(self.keys):
            return found
        which = np.arange(len(starts))
        state = np.full(len(starts), self.root[0], np.int64)
        total = np.zeros(len(starts), np.int64)
        at, stop = starts.copy(), ends.copy()
        while len(which):
            over = at >= stop
            if over.any():
                hit = over & self.finals[state]
                found[which[hit]] = total[hit]
                which, state, total, at, stop = (x[~over] for x in (which, state, total, at, stop))
                if not len(which):
                    break
            keys = (state << 8) | data[at]
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[place] == keys
            place = place[known]
            which, total, at, stop = which[known], total[known] + self.adds[place], at[known] + 1, stop[known]
            state = self.targets[place]
        return found

    def tobytes(self) -> bytes:
        parts = [np.ascontiguousarray(getattr(self, n), np.int64) for n in self.NAMES]
        return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(p.tobytes() for p in parts)

    @classmethod
    def mapped(cls, path: str) -> "Transducer":
        values = np.memmap(path, np.int64, "r")
        ends = len(cls.NAMES) + np.cumsum(values[: len(cls.NAMES)])
        parts = [np.asarray(values[a:b]) for a, b in zip([len(cls.NAMES), *ends[:-1]], ends)]
        made = cls(*parts)
        made.finals = made.finals.astype(bool)
        return made


def compile_words(words: list[bytes], vocabulary: Vocabulary) -> Transducer:
    """Sorted words become a minimal automaton: states alike are kept once."""
    words = sorted(set(words))
    register: dict[tuple, int] = {}
    sizes: list[int] = []
    path: list[list] = [[False, []]]  # [final, [(byte, state), ...]] along the last word

    def freeze(depth: int) -> int:
        last = -1
        while len(path) > depth:
            final, edges = path.pop()
            key = (final, tuple(edges))
            last = register.get(key, -1)
            if last < 0:
                last = register[key] = len(register)
                sizes.append(final + sum(sizes[s] for _, s in edges))
            if path:
                path[-1][1][-1] = (path[-1][1][-1][0], last)
        return last

    previous = b""
    for word in words:
        common = len(os.path.commonprefix([previous, word]))
        freeze(common + 1)
        for byte in word[common:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        previous = word
    root = freeze(0)
    keys, targets, adds = [], [], []
    finals = np.zeros(len(register), bool)
    for (final, edges), state in register.items():
        finals[state] = final
        before = int(final)
        for byte, target in edges:
            keys.append(state << 8 | byte)
            targets.append(target)
            adds.append(before)
            before += sizes[target]
    blob, offsets = ragged_bytes(words)
    ids, counts = merge_many(blob, offsets[:-1], offsets[1:], vocabulary)
    as_array = functools.partial(np.array, dtype=np.int64)
    return Transducer(as_array(keys), as_array(targets), as_array(adds), finals, as_array([root]), ids, np.append(0, np.cumsum(counts)).astype(np.int64))


# ---------------------------------------------------------------- encoding


class Encoder:
    """Encodes and decodes blocks of texts; remembers merged words up to a bound."""

    def __init__(self, vocabulary: Vocabulary, transducer: Transducer | None = None, remembered: int = 200_000) -> None:
        self.vocabulary, self.transducer, self.remembered = vocabulary, transducer, remembered
        self._forget()

    def _forget(self) -> None:
        # a word's number, and all words' ids in a row
        self.known: dict[bytes, int] = {}
        self.ids, self.id_offsets = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _merged(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``merge_many``, for words that differ."""
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        numbers = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        ids, counts = merge_many(data, starts[new], ends[new], self.vocabulary)
        table = np.concatenate([self.ids, ids])
        offsets = np.append(self.id_offsets, self.id_offsets[-1] + np.cumsum(counts))
        numbers[new] = len(self.known) + np.arange(len(new))
        sizes = offsets[numbers + 1] - offsets[numbers]
        found = table[ragged(offsets[numbers], sizes)]
        if len(self.known) + len(new) > self.remembered:
            self._forget()
            table, offsets = ids, np.append(0, np.cumsum(counts))
        self.known.update(zip([words[n] for n in new.tolist()], range(len(self.known), len(self.known) + len(new))))
        self.ids, self.id_offsets = table, offsets
        return found, sizes

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts of a block, and where each text's ids begin."""
        starts = split_words(data, offsets, self.vocabulary.specials)
        ends = np.append(starts[1:], len(data)).astype(np.int64)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        first, back = same_words(data, starts, ends)
        starts_u, ends_u = starts[first], ends[first]
        numbers = self.transducer.numbers(data, starts_u, ends_u) if self.transducer else np.full(len(first), -1)
        special = np.full(len(first), -1, np.int64)
        for text, number in self.vocabulary.specials.items():
            for u in np.flatnonzero(ends_u - starts_u == len(text)):
                if data[starts_u[u] : ends_u[u]].tobytes() == text:
                    special[u], numbers[u] = number, -1
        left = np.flatnonzero((numbers < 0) & (special < 0))
        ids, counts = self._merged(data, starts_u[left], ends_u[left])
        # one table of ids: the automaton's, then the merged words', then the special ones
        own = self.transducer.ids if self.transducer else np.zeros(0, np.int64)
        marks = np.flatnonzero(special >= 0)
        table = np.concatenate([own, ids, special[marks]])
        at, size = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        if self.transducer:
            held = np.flatnonzero(numbers >= 0)
            at[held] = self.transducer.id_offsets[numbers[held]]
            size[held] = self.transducer.id_offsets[numbers[held] + 1] - at[held]
        at[left], size[left] = len(own) + np.cumsum(counts) - counts, counts
        at[marks], size[marks] = len(own) + len(ids) + np.arange(len(marks)), 1
        all_sizes = size[back]
        run = np.append(0, np.cumsum(all_sizes))
        return table[ragged(at[back], all_sizes)], run[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray, id_offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts' bytes, from the tokens' bytes alone."""
        sizes = np.diff(self.vocabulary.token_offsets)[ids]
        run = np.append(0, np.cumsum(sizes))
        return self.vocabulary.token_bytes[ragged(self.vocabulary.token_offsets[ids], sizes)], run[id_offsets]


_encoders: dict[str, Encoder] = {}


def worker_encoder(vocabulary_box, lexicon: str | None) -> Encoder:
    """This worker's encoder; the automaton is mapped once and kept between tasks."""
    key = f"{vocabulary_box.id}-{lexicon}"
    if key not in _encoders:
        _encoders.clear()
        transducer = Transducer.mapped(SparkFiles.get(lexicon)) if lexicon else None
        _encoders[key] = Encoder(vocabulary_box.value, transducer)
    return _encoders[key]


class VocabularyBox:
    """A broadcast vocabulary with a name that workers can compare."""

    def __init__(self, spark, path: str) -> None:
        vocabulary = load_vocabulary(path)
        self.driver_value = vocabulary
        self.id = hashlib.sha256(vocabulary.token_bytes.tobytes() + vocabulary.pair_keys.tobytes()).hexdigest()[:16]
        self.sent = spark.sparkContext.broadcast(vocabulary)

    def __getstate__(self):
        return {"id": self.id, "sent": self.sent}

    @property
    def value(self) -> Vocabulary:
        return self.sent.value


def frequent_words(docs: DataFrame, text: str = "text", words: int = LEXICON_WORDS, counted: int = COUNTED_WORDS) -> list[bytes]:
    """The words most often found in all texts.

    A task keeps at most ``counted`` words; when there are more it takes the count of the
    first one beyond from all, as in a frequent-items summary, so each count is short by
    at most the task's words divided by ``counted``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                starts = split_words(data, offsets, {})
                ends = np.append(starts[1:], len(data)).astype(np.int64)
                if not len(starts):
                    continue
                first, codes = same_words(data, starts, ends)
                number = np.bincount(codes, minlength=len(first))
                raw = data.tobytes()
                for a, b, n in zip(starts[first].tolist(), ends[first].tolist(), number.tolist()):
                    if b - a <= BATCH_WORD_BYTES:
                        word = raw[a:b]
                        counts[word] = counts.get(word, 0) + n
                if len(counts) > 2 * counted:
                    counts = _cut(counts, counted)
        counts = _cut(counts, counted)
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    ranked = stored(docs.select(text).mapInArrow(count, schema).groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"), "words")
    # how many words occur so often: from these few counts, the least count among the chosen
    ladder = ranked.groupBy(F.floor(F.log2("n") * 16).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    taken, least = 0, 0
    for step, n in sorted(((r.step, r.n) for r in ladder), reverse=True):
        taken, least = taken + n, step
        if taken >= words:
            break
    some = ranked.where(F.floor(F.log2("n") * 16) >= least)
    rows = some.orderBy(F.desc("n"), "word").limit(words).select("word").collect()
    return [bytes(r.word) for r in rows]


def _cut(counts: dict[bytes, int], size: int) -> dict[bytes, int]:
    if len(counts) <= size:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    beyond = int(np.partition(values, len(values) - size - 1)[len(values) - size - 1])
    return {w: n - beyond for w, n in counts.items() if n > beyond}


#: Files that an application's executors can fetch already.
_shared: set[tuple[str, str]] = set()


def share_transducer(spark, transducer: Transducer) -> str:
    """Hand the automaton to all executors through Spark; returns its file's name."""
    content = transducer.tobytes()
    name = f"lexicon-{hashlib.sha256(content).hexdigest()[:24]}.bin"
    known = (spark.sparkContext.applicationId, name)
    if known in _shared:
        return name
    folder = os.path.realpath(tempfile.mkdtemp(prefix="strata-"))
    with open(os.path.join(folder, name), "wb") as file:
        file.write(content)
    spark.sparkContext.addFile(os.path.join(folder, name))
    _shared.add(known)
    return name


def prepared(docs: DataFrame, vocabulary_path: str, text: str = "text", words: int = LEXICON_WORDS) -> tuple[VocabularyBox, str]:
    """The vocabulary on all executors and the compiled lexicon of these documents."""
    spark = docs.sparkSession
    box = VocabularyBox(spark, vocabulary_path)
    name = share_transducer(spark, compile_words(frequent_words(docs, text, words), box.driver_value))
    return box, name


def encode(docs: DataFrame, vocabulary_path: str, text: str = "text", words: int = LEXICON_WORDS, ids: str = "token_ids") -> DataFrame:
    """All columns but the text, with the texts' token ids as an array column."""
    box, name = prepared(docs, vocabulary_path, text, words)

    def work(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        tokens, begins = worker_encoder(box, name).encode(data, offsets)
        return [pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(tokens.astype(np.int32)))]

    return map_texts(docs, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], work)


def decode(encoded: DataFrame, vocabulary_path: str, ids: str = "token_ids", text: str = "text") -> DataFrame:
    """All columns but the ids, with the decoded text; NULL ids decode to the empty text."""
    box = VocabularyBox(encoded.sparkSession, vocabulary_path)
    kept = [c for c in encoded.columns if c not in (ids, text)]
    schema = T.StructType([encoded.schema[c] for c in kept] + [T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(box, None)
        for batch in batches:
            texts = []
            for row in batch.column(len(kept)):
                tokens = np.array(row.as_py() or [], np.int64)
                data, _ = encoder.decode(tokens, np.array([0, len(tokens)]))
                texts.append(data.tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(len(kept))] + [pa.array(texts, pa.string())], schema.names)

    return encoded.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{ids}`").alias("__ids")).mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, vocabulary_path: str, text: str = "text", words: int = LEXICON_WORDS) -> DataFrame:
    """Encode and decode every text; number of tokens and digests of ids and text."""
    box, name = prepared(docs, vocabulary_path, text, words)

    def work(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        encoder = worker_encoder(box, name)
        tokens, begins = encoder.encode(data, offsets)
        if not hasattr(encoder, "digits"):
            encoder.digits = encoder.vocabulary.digits()
        blob, at = encoder.digits
        sizes = np.diff(at)[tokens]
        shown = blob[ragged(at[tokens], sizes)].tobytes()
        ends = np.append(0, np.cumsum(sizes))[begins].tolist()
        back, text_ends = encoder.decode(tokens, begins)
        raw, text_ends = back.tobytes(), text_ends.tolist()
        id_digests = [hashlib.sha256(shown[a : max(a, b - 1)]).hexdigest() for a, b in zip(ends, ends[1:])]
        texts = [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(text_ends, text_ends[1:])]
        return [pa.array(np.diff(begins)), pa.array(id_digests), pa.array([hashlib.sha256(t).hexdigest() for t in texts])]

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return map_texts(docs, text, fields, work)
