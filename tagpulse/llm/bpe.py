"""Byte-level BPE: text to ids and back, as the rank file of a public tokenizer says.

Each match of the split pattern is encoded by itself. A minimal perfect hash over the
vocabulary resolves pre-tokens that are one token; any other goes through a heap of ranked
pairs over a linked list of its bytes. No special tokens.

Null text counts as empty; the empty text has no ids and decodes to no bytes. Texts of any
length are split in pieces at blanks between two non-blanks, where no match can cross.
Repeated rows are encoded alike; other columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode, in place of ``\s``, which means a little more to ``regex``.
BLANKS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Pre-tokens kept with their ids in each worker; a full memo is emptied, results are the same.
MEMO_ENTRIES = 300_000
MEMO_CHARS = 48
PIECE_CHARS = 1_000_000
_MASK = (1 << 64) - 1


def _slot(hashed: int, seed: int, slots: int) -> int:
    mixed = (hashed ^ (seed * 0x9E3779B97F4A7C15 & _MASK)) * 0xBF58476D1CE4E5B9 & _MASK
    return (mixed ^ mixed >> 31) % slots


class PerfectHash:
    """Minimal perfect hash by displacement: as many slots as keys, one probe for a key.

    Keys fall into buckets; a bucket's displacement sends its keys to free slots. A bucket of
    one key names its slot itself, as ``-1 - slot``.
    """

    def __init__(self, keys: list[bytes]):
        self.buckets = max(1, len(keys) // 2)
        self.slots = max(1, len(keys))
        hashed = [xxhash.xxh3_64_intdigest(key) for key in keys]
        if len(set(hashed)) < len(keys):
            raise ValueError("keys repeat")
        members: dict[int, list[int]] = {}
        for i, h in enumerate(hashed):
            members.setdefault(h % self.buckets, []).append(i)
        self.displacement = [0] * self.buckets
        self.at = [-1] * self.slots
        free = self.slots - 1
        for bucket, inside in sorted(members.items(), key=lambda item: -len(item[1])):
            if len(inside) == 1:
                while self.at[free] >= 0:
                    free -= 1
                self.at[free] = inside[0]
                self.displacement[bucket] = -1 - free
                continue
            seed = 0
            while True:
                places = [_slot(hashed[i], seed, self.slots) for i in inside]
                if len(set(places)) == len(places) and all(self.at[p] < 0 for p in places):
                    break
                seed += 1
            for i, place in zip(inside, places, strict=True):
                self.at[place] = i
            self.displacement[bucket] = seed

    def candidate(self, key: bytes) -> int:
        """The only index that ``key`` can have; the caller compares the key there."""
        hashed = xxhash.xxh3_64_intdigest(key)
        seed = self.displacement[hashed % self.buckets]
        return self.at[-1 - seed if seed < 0 else _slot(hashed, seed, self.slots)]


def _spelled(pattern: str, classes: dict[str, str]) -> str:
    """The pattern with its named classes written out, bare inside brackets."""
    negated = {name.upper(): members for name, members in classes.items() if len(name) == 1}

    def inside(match: re.Match) -> str:
        out = match[0]
        for name, members in classes.items():
            out = out.replace(f"\\{name}", members)
        return out

    out = re.sub(r"\[[^\]]*\]", inside, pattern)
    for name, members in classes.items():
        out = out.replace(f"\\{name}", f"[{members}]")
    for name, members in negated.items():
        out = out.replace(f"\\{name}", f"[^{members}]")
    return out


class Vocabulary:
    """Tokens by rank, the perfect hash over them, and the pattern that splits texts."""

    def __init__(self, tokens: dict[int, bytes], pattern: str):
        self.ids = sorted(tokens)
        self.tokens = [tokens[i] for i in self.ids]
        self.hash = PerfectHash(self.tokens)
        self.pattern = _spelled(pattern, {"s": BLANKS})
        #: The same for ASCII texts, for the faster library; None if it has other classes.
        ascii_only = _spelled(pattern, {"s": r"\t-\r ", "p{L}": "A-Za-z", "p{N}": "0-9"})
        self.ascii_pattern = None if re.search(r"\\[pP]", ascii_only) else ascii_only

    def whole(self, piece: bytes) -> int | None:
        i = self.hash.candidate(piece)
        return self.ids[i] if i >= 0 and self.tokens[i] == piece else None


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> Vocabulary:
    """A rank file: a line holds a token in base64 and its rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return Vocabulary({int(rank): base64.b64decode(token) for token, rank in pairs}, pattern)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the pair of lowest rank, leftmost first, until no pair has a rank."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the token that starts here; 0 once it is joined
    before = list(range(-1, n - 1))
    heap = []
    for s in range(n - 1):
        if (rank := ranks.get(piece[s : s + 2])) is not None:
            heap.append((rank, s, s + 1, s + 2))
    heapq.heapify(heap)
    while heap:
        _, s, middle, e = heapq.heappop(heap)
        if end[s] != middle or end[middle] != e:
            continue  # one of the two has been joined since
        end[s], end[middle] = e, 0
        if e < n:
            before[e] = s
            if (rank := ranks.get(piece[s : end[e]])) is not None:
                heapq.heappush(heap, (rank, s, e, end[e]))
        if (p := before[s]) >= 0 and (rank := ranks.get(piece[p:e])) is not None:
            heapq.heappush(heap, (rank, p, s, e))
    ids, s = [], 0
    while s < n:
        ids.append(ranks[piece[s : end[s]]])
        s = end[s]
    return ids


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ranks = dict(zip(vocabulary.tokens, vocabulary.ids, strict=True))
        self.split = regex.compile(vocabulary.pattern).findall
        fast = vocabulary.ascii_pattern
        self.split_ascii = self.split if fast is None else re.compile(fast).findall
        self.cut = regex.compile(rf"(?<=[^{BLANKS}]) (?=[^{BLANKS}])").search
        self.memo: dict[str, tuple[int, ...]] = {}

    def _pre_token(self, text: str) -> tuple[int, ...]:
        piece = text.encode()
        whole = self.vocabulary.whole(piece)
        return (whole,) if whole is not None else tuple(merge(piece, self.ranks))

    def _pieces(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > PIECE_CHARS and (cut := self.cut(text, start + PIECE_CHARS)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def __call__(self, text: str) -> list[int]:
        out = array("i")
        self.extend(out, text)
        return out.tolist()

    def extend(self, out: array, text: str) -> None:
        """Append the ids of a text."""
        for piece in self._pieces(text):
            words = (self.split_ascii if piece.isascii() else self.split)(piece)
            memo = self.memo
            long: dict[str, tuple[int, ...]] = {}
            for word in set(words).difference(memo):
                (memo if len(word) <= MEMO_CHARS else long)[word] = self._pre_token(word)
            if long:
                out.extend(chain.from_iterable(long.get(w) or memo[w] for w in words))
            else:
                out.extend(chain.from_iterable(map(memo.__getitem__, words)))
            if len(memo) > MEMO_ENTRIES:
                memo.clear()


def _ids_of(batch: pa.Array, encoder: Encoder) -> pa.ListArray:
    out, offsets = array("i"), [0]
    for value in batch:
        encoder.extend(out, value.as_py())
        offsets.append(len(out))
    values = pa.Array.from_buffers(pa.int32(), len(out), [None, pa.py_buffer(out)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _bytes_of(ids: pa.ListArray, token: Callable[[int], bytes]) -> pa.Array:
    values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
    out, ends = bytearray(), [0]  # one copy of the bytes of a batch, not one as texts and one as their array
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        out += b"".join(map(token, values[a:b].tolist()))
        ends.append(len(out))
    where = pa.array(ends, pa.int32()).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, where, pa.py_buffer(out)])


def encode(text: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a text, as an array of integers."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            yield _ids_of(batch, encoder)

    return ids(F.coalesce(text, F.lit("")))


def encode_and_decode(text: Column, vocabulary: Vocabulary) -> Column:
    """``ids`` of a text and ``decoded``, the bytes these ids stand for, in one pass, without
    the ids leaving the task and coming back."""

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, token = Encoder(vocabulary), _tokens(vocabulary)
        for batch in batches:
            ids = _ids_of(batch, encoder)
            yield pa.StructArray.from_arrays([ids, _bytes_of(ids, token)], ["ids", "decoded"])

    # Evaluated once, wherever its fields are used.
    return both.asNondeterministic()(F.coalesce(text, F.lit("")))


def _tokens(vocabulary: Vocabulary) -> Callable[[int], bytes]:
    return dict(zip(vocabulary.ids, vocabulary.tokens, strict=True)).__getitem__


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes that ids stand for; null stands for none."""

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = _tokens(vocabulary)
        for batch in batches:
            yield _bytes_of(batch, token)

    return decoded(F.coalesce(ids, F.array().cast("array<int>")))
