"""Token ids of whole texts with a public tokenizer file, as little-endian bytes.

A byte-level BPE splits a text before it merges, and a text may be cut where
that split always cuts: in front of every run of white space, as white space
only ever begins a piece, and in front of a mark that follows a letter.  The
ids of the parts, one after the other, are the ids of the text.  The name of a
special token holds no white space and none of the marks, so it lies in one
part and becomes that token's id, as in the library's plain call.  Parts are
words and marks, and most of them were seen before: parts are cut and counted
as flat arrays, each worker keeps the ids of up to ``CACHE`` parts, and only
new ones go to the tokenizer, many as one text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from snaplake.llm.ragged import offsets, take_rows

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Parts whose ids one worker keeps (about 40 bytes each, 250 at most); beyond it those met only once are forgotten.
CACHE = 500_000
#: Bytes of a part from which on its ids are not kept: it hardly comes again.
LONG = 64
#: Bytes of text that are cut and looked up at a time (or one text).
SLICE = 4 << 20
#: Bytes of new parts that go to the tokenizer as one text (or one part).
TOGETHER = 1 << 17
_SPACES = np.isin(np.arange(256), list(b" \t\n\r"))
#: Marks are ASCII; the apostrophe begins pieces of its own ('s, 'll).
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTERS = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
#: White space beyond ASCII, as the number its UTF-8 bytes make.  It is at least what any tokenizer takes for
#: white space: fewer cuts are safe cuts.
_WIDE = np.array([int.from_bytes(chr(c).encode()) for c in (*range(0x80, 0xD800), *range(0xE000, 0x10000))
                  if chr(c).isspace() or c == 0x180E], np.uint32)
#: First bytes of parts that begin with no white space: ASCII, and those of UTF-8 that begin no wide one.
_PLAIN = np.array([0x21 <= b < 0x7F or b >= 0xC3 and b not in (0xE1, 0xE2, 0xE3) for b in range(256)])
_WORKER: dict[str, Encoder] = {}


def _wide_before(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a white space beyond ASCII ends in front of each place of ``raw``."""
    found = raw[np.maximum(at - 1, 0)] >= 0x80
    last = at[found]
    one, two, three = (raw[np.maximum(last - k, 0)].astype(np.uint32) for k in (1, 2, 3))
    pair = two << 8 | one
    found[found] = np.isin(pair, _WIDE) | np.isin(three << 16 | pair, _WIDE)
    return found


def _strings(ends: np.ndarray, data: pa.Buffer, kind: pa.DataType) -> pa.Array:
    """The rows of ``data`` between each of ``ends`` and the next, without a copy."""
    return pa.Array.from_buffers(kind, len(ends) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends, np.int64)), data])


def _flat(rows: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """(where each row of a large string or binary array begins, and the last ends; the bytes)."""
    _, at, data = rows.buffers()
    if not len(rows):
        return np.zeros(1, np.int64), pa.py_buffer(b"")
    return np.frombuffer(at, np.int64)[rows.offset:rows.offset + len(rows) + 1], data if data is not None else pa.py_buffer(b"")


class Encoder:
    """Ids of texts as bytes of ``dtype``: 2 bytes an id if the vocabulary allows, else 4."""

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        added = spec.get("added_tokens") or []
        if any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in added):
            raise ValueError("a special token that takes in white space cannot be cut at it")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)  # in this alphabet a character is a byte
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        split = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or split.get("type") != "ByteLevel" or not split.get("use_regex", True):
            raise ValueError("only a byte-level split without normalization can be cut at white space")
        names = "".join(t["content"] for t in added)
        self._marks = np.isin(np.arange(256), [ord(c) for c in _MARKS if c not in names])
        self.cache = cache
        self._forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's encoder for a file."""
        if path not in _WORKER:
            _WORKER[path] = cls(path)
        return _WORKER[path]

    def _forget(self) -> None:
        self._known, self._ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self._uses = np.zeros(0, np.int64)

    def pack(self, ids: list[int] | np.ndarray) -> bytes:
        return np.asarray(ids, self.dtype).tobytes()

    def _cuts(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where parts begin in the bytes of texts that begin at ``starts`` (ascending, none of them empty)."""
        spaces = np.flatnonzero(_SPACES[raw])
        spaces = spaces[(raw[np.maximum(spaces - 1, 0)] > 32) & ~_wide_before(raw, spaces)]
        marks = np.flatnonzero(self._marks[raw])
        before, lead = raw[np.maximum(marks - 1, 0)], raw[np.maximum(marks - 2, 0)]
        # from U+00C0 to U+023F all are letters but the signs of multiplication and division
        latin = (before >= 0x80) & (lead >= 0xC3) & (lead <= 0xC8) & ~((lead == 0xC3) & ((before == 0x97) | (before == 0xB7)))
        begins = np.zeros(len(raw), bool)
        for at in (spaces, marks[_LETTERS[before] | latin], starts):
            begins[at] = True
        return np.flatnonzero(begins)

    def _joined(self, parts: pa.Array, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per part) of parts that may stand one after the other, each without its first ``skip`` ids."""
        ends, data = _flat(parts)
        ids, counts, low = [], [], 0
        while low < len(parts):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + TOGETHER, side="right")) - 1)
            text = data[int(ends[low]):int(ends[high])].to_pybytes().decode()
            found = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            token_ends = np.cumsum(self.bytes_of[found])
            wanted = ends[low + 1:high + 1] - ends[low]
            cuts = np.searchsorted(token_ends, wanted) + 1
            if not np.array_equal(token_ends[np.minimum(cuts, len(found)) - 1], wanted):
                raise ValueError("a token runs over a part's end")
            per = np.diff(cuts, prepend=0)
            ids.append(found[take_rows(cuts - per + skip, per - skip)] if skip else found)
            counts.append(per - skip)
            low = high
        return np.concatenate(ids), np.concatenate(counts)

    def _learn(self, parts: pa.Array) -> pa.Array:
        """The ids of parts, as bytes.

        Parts that begin with white space follow one another as one text, the
        others do with a line feed before each, and the tokens are cut where
        the bytes of the parts end.  A part that ends in white space would run
        into the next one, so it is a text of its own.
        """
        ends, data = _flat(parts)
        raw = np.frombuffer(data, np.uint8)
        first = raw[ends[:-1]]
        closed = (raw[ends[1:] - 1] > 32) & ~_wide_before(raw, ends[1:])
        led, plain = closed & _SPACES[first], closed & _PLAIN[first]
        found, order = [], []
        for which, skip in ((led, 0), (plain, 1)):
            if which.any():
                some = parts.filter(pa.array(which))
                if skip:
                    held, text = _flat(some)
                    per = np.diff(held)
                    wide = np.full(int(held[-1] - held[0]) + len(some), 10, np.uint8)
                    at = offsets(per + 1)
                    wide[take_rows(at[:-1] + 1, per)] = np.frombuffer(text, np.uint8)[held[0]:held[-1]]
                    some = _strings(at, pa.py_buffer(wide), pa.large_string())
                found.append(self._joined(some, skip))
                order.append(np.flatnonzero(which))
        alone = np.flatnonzero(~(led | plain))
        if len(alone):
            ids = [x.ids for x in self.tokenizer.encode_batch_fast(parts.take(pa.array(alone)).to_pylist(), add_special_tokens=False)]
            found.append((np.concatenate([np.array(x, np.int64) for x in ids]), np.array([len(x) for x in ids], np.int64)))
            order.append(alone)
        ids = np.concatenate([x for x, _ in found]).astype(self.dtype)
        rows = _strings(offsets(np.concatenate([n for _, n in found])) * self.dtype.itemsize, pa.py_buffer(ids), pa.large_binary())
        return rows.take(pa.array(np.argsort(np.concatenate(order), kind="stable")))

    def _slice(self, ends: np.ndarray, data: pa.Buffer) -> Iterator[bytes]:
        """The ids of texts that lie between each of ``ends`` and the next."""
        low = int(ends[0])
        data, ends = data[low:int(ends[-1])], ends - low
        raw = np.frombuffer(data, np.uint8)
        if not len(raw):
            yield from [b""] * (len(ends) - 1)
            return
        cuts = self._cuts(raw, ends[:-1][np.diff(ends) > 0])
        parts = _strings(np.append(cuts, len(raw)), data, pa.large_string())
        # known parts come first, so they keep their places and new ones follow
        coded = pa.chunked_array([self._known, parts]).dictionary_encode().chunks[-1]
        codes, parts = coded.indices, coded.dictionary
        if len(parts) > len(self._known):
            self._ids = pa.concat_arrays([self._ids, self._learn(parts[len(self._known):])])
            self._known = parts
        table = self._ids
        self._count(codes.to_numpy())
        where, ids = _flat(table.take(codes))
        places = where[np.searchsorted(cuts, ends)].tolist()
        ids = memoryview(ids)
        for a, b in zip(places, places[1:]):
            yield bytes(ids[a:b])

    def _count(self, codes: np.ndarray) -> None:
        """Count the uses of parts, and forget long ones and, when there are too many, those met only once."""
        uses = np.bincount(codes, minlength=len(self._known))
        uses[:len(self._uses)] += self._uses
        keep = np.diff(_flat(self._known)[0]) <= LONG
        if keep.sum() > self.cache:
            keep &= uses > 1
            if keep.sum() > self.cache // 2:
                self._forget()
                return
            uses[:] = 1  # from here on anew
        if not keep.all():
            which = pa.array(keep)
            self._known, self._ids, uses = self._known.filter(which), self._ids.filter(which), uses[keep]
        self._uses = uses

    def encode(self, texts: pa.Array | Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, NULL and empty ones none."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(list(texts), pa.large_string())
        texts = texts.cast(pa.large_string()).fill_null("")
        ends, data = _flat(texts)
        low = 0
        while low < len(texts):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + SLICE, side="right")) - 1)
            yield from self._slice(ends[low:high + 1], data)
            low = high
