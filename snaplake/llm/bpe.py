"""Byte-level BPE in numpy: encoding and decoding of whole texts.

The symbols of many words lie in one flat array.  The rank of a pair of
neighbours is found by binary search over the sorted pair keys.  A round takes
the lowest rank of every word and merges all its pairs there at once; only the
pairs beside a merge are searched again, and words that are done leave the
array.  A merge ranks after those that made its parts (checked for the file),
so a round never changes what an earlier one should have done.

That costs a word its length times its merges.  Words over ``LONG`` symbols
share rounds of another kind: a round takes the lowest rank that is left in
any of them, with links between neighbours instead of a packed array, which
costs their length times a logarithm.

A text is cut in front of every run of white space: a byte-level split never
joins what lies on both sides of such a cut.  Most parts were seen before;
a worker keeps the ids of known parts and merges only new ones.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import col
from snaplake.llm.ragged import offsets, take_rows

#: Characters of parts whose ids one worker keeps (some 400,000 parts, 80 MB); beyond them it starts anew.
CACHE = 4 << 20
#: Characters of text that are coded in one go.
SLICE = 2 << 20
#: Symbols of a word from which on its merges go rank by rank.
LONG = 200
#: A cut is at a single space between two characters that are no white space in Python's sense
#: (which is at least what any tokenizer takes for it: fewer cuts are safe cuts).
_AT_SPACE = re.compile(r"(?<=\S) (?=\S)")
_INNER = re.compile(r"\s ")
# Fixed value: the pattern that byte-level files split text by.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Below it every version of Unicode has the same letters, digits and spaces (tried when a file is opened);
#: words with other characters are split by the tokenizer library, whose version counts.
_LATIN_END = "\u0250"
_BEYOND_LATIN = re.compile(f"[{_LATIN_END}-\U0010FFFF]")
_NO_RANK = np.iinfo(np.int64).max
_WORKER: dict[str, Bpe] = {}


def cut_at_spaces(text: str) -> list[str]:
    """The parts of a text; the space between two parts belongs to the second and is left out."""
    return _AT_SPACE.split(text) if _INNER.search(text) else text.split(" ")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Bpe:
    """A byte-level BPE file.  ``special=False`` takes the names of special tokens for ordinary text."""

    def __init__(self, path: str, special: bool = True, cache: int = CACHE):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        fits = (model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                and not split.get("add_prefix_space") and not spec.get("normalizer") and not model.get("dropout")
                and not model.get("ignore_merges") and not model.get("continuing_subword_prefix")
                and not model.get("end_of_word_suffix"))
        added = spec.get("added_tokens") or []
        if not fits or any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in added):
            raise ValueError(f"{path}: only a plain byte-level BPE is coded here")
        self._library_split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._pattern = regex.compile(_PATTERN)
        latin = "".join(f"a{c}1{c}!{c} a{c}{c} " for c in map(chr, range(ord(_LATIN_END))))
        self._same_classes = self._pattern.findall(latin) == [latin[a:b] for _, (a, b) in self._library_split(latin)]
        vocabulary: dict[str, int] = model["vocab"]
        self.size = max([*vocabulary.values(), *[t["id"] for t in added]]) + 1
        alphabet = byte_characters()
        self._symbol = np.array([vocabulary[c] for c in alphabet], np.int64)  # byte -> id
        self._learn_merges(vocabulary, model["merges"])
        byte_of = {c: b for b, c in enumerate(alphabet)}

        def content(token: str) -> bytes:
            return bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()

        table = [b""] * self.size
        for token, i in [*vocabulary.items(), *[(t["content"], t["id"]) for t in added]]:
            table[i] = content(token)
        self.token_bytes = table
        self._bytes = np.frombuffer(b"".join(table), np.uint8)
        self._byte_starts = offsets(np.array([len(t) for t in table]))
        names = sorted((t["content"] for t in added), key=len, reverse=True) if special else []
        self._special = {t["content"]: t["id"] for t in added}
        self._names = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.cache = cache
        self._forget()

    @classmethod
    def of(cls, path: str, special: bool = True) -> Bpe:
        """The worker's tables for a file."""
        key = f"{special}:{path}"
        if key not in _WORKER:
            _WORKER[key] = cls(path, special)
        return _WORKER[key]

    def _learn_merges(self, vocabulary: dict[str, int], merges: list) -> None:
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        self._made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        made_at = np.full(self.size, -1, np.int64)
        made_at[self._made[::-1]] = np.arange(len(pairs))[::-1]
        if (np.maximum(made_at[left], made_at[right]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge comes before one that makes its parts")
        keys = left * (self.size + 1) + right
        self._rank_of = np.argsort(keys, kind="stable")
        self._keys = keys[self._rank_of]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, by binary search over the sorted pair keys."""
        key = left * (self.size + 1) + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._rank_of[at], _NO_RANK)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word) of words of byte symbols in one flat array."""
        long = lengths > LONG
        if not long.any():
            return self._merge_rounds(symbols, lengths)
        starts = offsets(lengths)[:-1]
        parts = [(np.flatnonzero(which), *run(symbols[take_rows(starts[which], lengths[which])], lengths[which]))
                 for which, run in ((long, self._merge_long), (~long, self._merge_rounds))]
        return _in_order(parts, len(lengths))

    def _merge_rounds(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rounds by word: each takes the lowest rank of every word."""
        word = np.flatnonzero(lengths)
        size, held = lengths[word], symbols
        done = []
        last = np.zeros(len(held), bool)
        last[np.cumsum(size) - 1] = True
        rank = np.full(len(held), _NO_RANK)
        inner = np.flatnonzero(~last)
        rank[inner] = self.ranks(held[inner], held[inner + 1])
        while len(word):
            best = np.minimum.reduceat(rank, offsets(size)[:-1])
            more = best != _NO_RANK
            if not more.all():
                stays = np.repeat(more, size)
                done.append((word[~more], held[~stays], size[~more]))
                word, size, best = word[more], size[more], best[more]
                held, rank, last = held[stays], rank[stays], last[stays]
                if not len(word):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            at = at[_every_second(np.diff(at) == 1)]
            held[at] = self._made[rank[at]]
            last[at] = last[at + 1]
            stays = np.ones(len(held), bool)
            stays[at + 1] = False
            ends = np.cumsum(size)
            size = size - np.diff(np.searchsorted(at, np.concatenate(([0], ends))))
            held, rank, last = held[stays], rank[stays], last[stays]
            at = at - np.arange(len(at))  # where the merged symbols are now
            rank[at] = _NO_RANK
            prior = at[at > 0] - 1
            touched = np.concatenate((prior, at))
            touched = touched[~last[touched]]
            rank[touched] = self.ranks(held[touched], held[touched + 1])
        return _in_order(done, len(lengths))

    def _merge_long(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rounds by rank: each takes the lowest rank that is left in any word."""
        n, ends = len(symbols), np.cumsum(lengths)
        held = np.append(symbols, self.size)  # the last place is no symbol: a pair with it has no rank
        after = np.arange(1, n + 2)
        after[ends[lengths > 0] - 1] = n
        before = np.arange(-1, n)
        before[(ends - lengths)[lengths > 0]] = -1
        before[n] = -1
        rank = np.full(n + 1, _NO_RANK)
        rank[:n] = self.ranks(held[:n], held[after[:n]])
        waiting: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def wait(at: np.ndarray) -> None:
            at = at[rank[at] != _NO_RANK]
            if len(at) > 1:
                at = at[np.argsort(rank[at], kind="stable")]
                cuts = np.flatnonzero(np.diff(rank[at])) + 1
                groups = np.split(at, cuts) if len(cuts) else [at]
            else:
                groups = [at] if len(at) else []
            for g in groups:
                r = int(rank[g[0]])
                if r in waiting:
                    waiting[r].append(g)
                else:
                    waiting[r] = [g]
                    heapq.heappush(order, r)

        wait(np.arange(n))
        while order:
            r = heapq.heappop(order)
            groups = waiting.pop(r)
            at = np.unique(np.concatenate(groups)) if len(groups) > 1 else groups[0]
            at = at[rank[at] == r]
            if len(at) > 1:
                at = at[_every_second(after[at[:-1]] == at[1:])]
            if not len(at):
                continue
            gone = after[at]
            held[at] = self._made[r]
            beyond = after[gone]
            after[at] = beyond
            before[beyond] = at
            rank[gone] = _NO_RANK
            held[gone] = -1
            prior = before[at]
            touched = np.concatenate((prior[prior >= 0], at)) if len(at) == 1 else np.unique(
                np.concatenate((prior[prior >= 0], at)))
            rank[touched] = self.ranks(held[touched], held[after[touched]])
            wait(touched)
        alive = held[:n] >= 0
        return held[:n][alive], np.diff(np.concatenate(([0], np.cumsum(alive)))[offsets(lengths)])

    def _split(self, text: str) -> list[str]:
        """The words of a text, which together are the text."""
        if self._same_classes and not _BEYOND_LATIN.search(text):
            return self._pattern.findall(text)
        return [text[a:b] for _, (a, b) in self._library_split(text)]

    def _words(self, parts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(words of all parts, words per part, the parts in the words' order); special tokens are words too.

        A part that begins with a space and ends with none may follow another
        such part: those are split as one text, and the places of the words
        tell where each part ends.
        """
        alone = [i for i, p in enumerate(parts) if not p or p[0] != " " or p[-1].isspace()
                 or (self._names is not None and self._names.search(p))]
        words: list[str] = []
        counts = np.zeros(len(parts), np.int64)
        for i in alone:
            before = len(words)
            for k, piece in enumerate(self._names.split(parts[i]) if self._names else (parts[i],)):
                if k % 2:
                    words.append(piece)
                elif piece:
                    words += self._split(piece)
            counts[i] = len(words) - before
        order = np.array(alone, np.int64)
        if len(alone) < len(parts):
            apart = set(alone)
            rest = [i for i in range(len(parts)) if i not in apart]
            latin = [i for i in rest if not _BEYOND_LATIN.search(parts[i])]
            if len(latin) < len(rest):
                held = set(latin)
                rest = [latin, [i for i in rest if i not in held]]
            else:
                rest = [rest]
            for some in rest:
                if not some:
                    continue
                found = self._split("".join([parts[i] for i in some]))
                ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
                part_ends = np.cumsum(np.fromiter((len(parts[i]) for i in some), np.int64, len(some)))
                last = np.searchsorted(ends, part_ends)
                if not np.array_equal(ends[last], part_ends):
                    raise ValueError("a word runs over a part's end")
                counts[some] = np.diff(np.concatenate(([-1], last)))
                words += found
                order = np.concatenate((order, np.array(some, np.int64)))
        return words, counts, order

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per part) of texts that are cut already; equal words are merged once."""
        words, per_part, order = self._words(parts)
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        which = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        distinct = list(number)
        special = {i: self._special[w] for i, w in enumerate(distinct) if w in self._special} if self._names else {}
        spelled = ["" if i in special else w for i, w in enumerate(distinct)] if special else distinct
        spelled = [w.encode() for w in spelled]
        symbols = self._symbol[np.frombuffer(b"".join(spelled), np.uint8)]
        ids, lengths = self.merge(symbols, np.fromiter(map(len, spelled), np.int64, len(spelled)))
        if special:
            starts = offsets(lengths)
            ids = np.insert(ids, starts[list(special)], list(special.values()))
            lengths[list(special)] = 1
        starts = offsets(lengths)
        of_word = lengths[which]
        ids = ids[take_rows(starts[which], of_word)]
        return _in_order([(order, ids, np.diff(offsets(of_word)[offsets(per_part[order])]))], len(parts))

    def _forget(self) -> None:
        self._led: dict[str, int] = {}  # parts by what follows their space
        self._first: dict[str, int] = {}  # parts that begin a text
        self._held = 0
        self._ids, self._starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _know(self, firsts: set[str], led: set[str]) -> None:
        """Learn the parts that are not known yet."""
        new_first, new_led = list(firsts.difference(self._first)), list(led.difference(self._led))
        more = sum(map(len, new_first)) + sum(map(len, new_led))
        if self._held and self._held + more > self.cache:
            self._forget()
            return self._know(firsts, led)
        if not new_first and not new_led:
            return
        known = len(self._starts) - 1
        self._first.update((p, known + i) for i, p in enumerate(new_first))
        self._led.update((p, known + len(new_first) + i) for i, p in enumerate(new_led))
        self._held += more
        ids, lengths = self.encode_parts(new_first + [" " + p for p in new_led])
        self._ids = np.concatenate((self._ids, ids.astype(np.int32)))
        self._starts = np.concatenate((self._starts, self._starts[-1] + np.cumsum(lengths)))

    def encode_slices(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, ends) of some texts after the other, ``ends`` from 0: about ``SLICE`` characters at a time."""
        for some in _slices(texts):
            cut = [cut_at_spaces(t) for t in some]
            firsts = [c.pop(0) for c in cut]
            self._know(set(firsts), set(chain.from_iterable(cut)))
            number = np.fromiter(chain.from_iterable(
                (self._first[f], *map(self._led.__getitem__, own)) for f, own in zip(firsts, cut)),
                np.int64, sum(map(len, cut)) + len(cut))
            lengths = np.diff(self._starts)[number]
            yield (self._ids[take_rows(self._starts[number], lengths)],
                   offsets(lengths)[offsets(np.array([len(c) + 1 for c in cut]))])

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, NULL and empty ones none."""
        for ids, ends in self.encode_slices(texts):
            for low, high in zip(ends[:-1].tolist(), ends[1:].tolist()):
                yield ids[low:high]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; special tokens are written out, bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < self.size)]
        starts = self._byte_starts[ids]
        return self._bytes[take_rows(starts, self._byte_starts[ids + 1] - starts)].tobytes().decode("utf-8", "replace")


def _every_second(linked: np.ndarray) -> np.ndarray:
    """Which of k + 1 places stay where ``linked`` says of each neighbour pair that it overlaps: in a run
    of overlapping ones (aaa), from the left every second."""
    k = np.arange(len(linked) + 1)
    if not linked.any():
        return k
    run = np.maximum.accumulate(np.where(np.concatenate(([False], linked)), 0, k))
    return k[(k - run) % 2 == 0]


def _in_order(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, lengths) of rows 0 .. n - 1 from lists of (row numbers, flat values, lengths); rows in none are empty."""
    lengths = np.zeros(n, np.int64)
    for rows, _, own in parts:
        lengths[rows] = own
    starts = offsets(lengths)
    flat = np.zeros(int(starts[-1]), np.int64)
    for rows, values, own in parts:
        flat[take_rows(starts[rows], own)] = values
    return flat, lengths


def _slices(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Texts in lists of about ``SLICE`` characters (one longer text is a list of its own)."""
    some, size = [], 0
    for t in texts:
        some.append(t or "")
        size += len(t or "")
        if size >= SLICE:
            yield some
            some, size = [], 0
    if some:
        yield some


def bpe_encode(text: Column, path: str, special: bool = True) -> Column:
    """The ids of a text column as an array of int: those of the tokenizer file's plain call without added tokens.

    The name of a special token in a text becomes that token's id; with
    ``special=False`` it is ordinary text.  NULL and empty texts give an empty
    array.  ``path`` must be the same file on all executors.
    """
    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        found = list(Bpe.of(path, special).encode(s.as_py() for s in texts))
        flat = np.concatenate(found) if found else np.zeros(0, np.int32)
        ends = offsets(np.array([len(f) for f in found], np.int64))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32)))
    return encode(text)


def bpe_decode(ids: Column, path: str) -> Column:
    """The text of a column of ids, special tokens written out; NULL gives NULL, an empty array an empty text."""
    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        bpe = Bpe.of(path)
        return pa.array([None if v is None else bpe.decode(np.asarray(v, np.int64)) for v in
                         (s.values.to_numpy(zero_copy_only=False) if s.is_valid else None for s in lists)], pa.string())
    return decode(ids)


def bpe_round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded) per row of ``docs``: its text's ids, and the text that these ids decode to.

    What :func:`bpe_encode` and :func:`bpe_decode` give, in one pass that holds
    a few texts at a time.  Rows stay as they are, repeated and NULL keys too;
    other columns are not read.  A NULL text has no ids and decodes to an empty
    text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.of(path)
        for batch in batches:
            at = 0
            for ids, ends in bpe.encode_slices(s.as_py() for s in batch.column("text")):
                cuts = ends.tolist()
                decoded = [bpe.decode(ids[low:high]) for low, high in zip(cuts, cuts[1:])]
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(at, len(decoded)), lists, pa.array(decoded, pa.string())],
                                                 [key, "ids", "decoded"])
                at += len(decoded)

    name = "`" + key.replace("`", "``") + "`"
    return docs.select(col(key).alias("key"), col(text).cast("string").alias("text")).mapInArrow(
        run, f"{name} {docs.schema[key].dataType.simpleString()}, ids array<int>, decoded string")
