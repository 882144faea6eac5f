import random
import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snaplake.llm.packing import fill, pack, padding, plan
from snaplake.llm.token_store import EliasFano, TokenFile, crc32_of_ids, finish, read_tokens, store_tokens, write_tokens
from snaplake.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
TEXTS = [None, "", " ", "\n", "a  b", "don't stop, we'll go; I'm.", "x.\nY \n z\t\tq  ", "  lead", "tail  ", "é  ü　 ß",
         "<|endoftext|> is a token", "x<|endoftext|>, y <|endoftext|>.", "a<|endoftext|><|endoftext|>b <|endoftext", "1,234.5 ²³ x², y³.", "á, b", "日本語 の テキスト。", "\x1c \x1d x", "a   b", "!!! ??? ...",
         "wörd's, it's. 's", "é. f", "tab\tand\x0bmore\x0cof\rit"]


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab Z9'.,!\n\t é 　日²́-s"), max_size=40))
def test_any_text_has_the_tokenizers_ids(text):
    e = Encoder.of(PATH)
    assert np.frombuffer(next(e.encode([text])), e.dtype).tolist() == ids_of(text)


def test_a_full_cache_starts_anew():
    e = Encoder(PATH, cache=5)
    texts = TEXTS + ["one two three four five six seven eight nine ten"] + TEXTS
    assert [np.frombuffer(b, e.dtype).tolist() for b in e.encode(texts)] == [ids_of(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2 ** 63), max_size=600))
def test_elias_fano_round_trip(values):
    values = sorted(values)
    e = EliasFano(EliasFano.encode(np.array(values, np.uint64)))
    assert e.values().tolist() == values
    assert [e.select(i) for i in range(0, len(values), 7)] == values[::7]
    for first, count in ((0, len(values) // 2), (len(values) // 3, len(values) - len(values) // 3), (len(values), 0)):
        assert e.run(first, count).tolist() == values[first:first + count]


def test_elias_fano_is_small_and_refuses_disorder():
    v = np.cumsum(np.random.default_rng(0).integers(0, 2000, 50_000)).astype(np.uint64)
    data = EliasFano.encode(v)
    assert len(data) * 8 / len(v) < 2.5 + np.log2(int(v[-1]) / len(v)) + 0.2
    e = EliasFano(data)
    assert [e.select(i) for i in (0, 255, 256, 257, 49_999)] == [int(v[i]) for i in (0, 255, 256, 257, 49_999)]
    assert EliasFano(EliasFano.encode(np.zeros(300, np.uint64))).select(299) == 0
    with pytest.raises(ValueError):
        EliasFano.encode(np.array([2, 1], np.uint64))


def test_file_reads_one_document_by_select():
    ids = [[5, 1], [], [7] * 300]
    data = b"".join(np.array(x, "<u2").tobytes() for x in ids) + finish([2, 0, 300], [None, -4, 9], 2)
    f = TokenFile(data)
    assert [f.document(i).tolist() for i in range(3)] == ids and f.doc_ids() == [None, -4, 9]


def corpus(n=150):
    r = random.Random(9)
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)]
    rows += [(1000 + i, " ".join("word%d" % r.randrange(500) for _ in range(int(r.paretovariate(0.8) * 20) % 4000))) for i in range(n)]
    return rows + [(3, "a  b"), (3, "other"), (None, "no id"), (None, None), (-5, "below")]


def test_store_equals_plain_encoding(docs, spark, tmp_path):
    rows = corpus()
    root = f"file://{tmp_path}/store"
    manifest = write_tokens(docs(rows), root, PATH, docs_per_shard=40)
    got = read_tokens(manifest, root)
    got = got.withColumn("crc", crc32_of_ids("n_tokens", "ids")).orderBy("start").collect()
    want = sorted(((d is not None, d or 0), ids_of(t) + [0]) for d, t in rows)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [k for k, _ in want]
    assert sorted((r.doc_id or 0, r.n_tokens, r.crc) for r in got) == sorted(
        (k[1], len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in want)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert manifest.count() > 2 and not [p for p in (tmp_path / "store/_temporary").iterdir()]
    again = write_tokens(docs(rows, parts=5), f"file://{tmp_path}/again", PATH, docs_per_shard=40)
    for r in again.collect():  # the same rows give the same files
        assert (tmp_path / "again" / r.file).read_bytes() == (tmp_path / "store" / r.file).read_bytes()


def test_empty_store(docs):
    assert store_tokens(docs([(1, "a")]).limit(0), PATH).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1, max_size=12))
def test_fill_leaves_the_least_slack(counts):
    got = fill(counts, 40)
    longest = max(counts)
    assert got[longest] >= 1 and all(got[x] <= counts[x] for x in got)
    reach = {longest}
    for x, n in counts.items():
        for _ in range(n - (x == longest)):
            reach |= {s + x for s in reach if s + x <= 40}
    assert sum(x * n for x, n in got.items()) == max(reach)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), min_size=1, max_size=30))
def test_plan_places_every_piece_once_without_gaps(counts):
    steps, filled = plan(counts, 64), {}
    for length, n in counts.items():
        own = steps[steps[:, 0] == length]
        assert own[0, 1] == 0 and own[-1, 2] == n and (own[1:, 1] == own[:-1, 2]).all()
    for length, a, b, per, first, offset in steps.tolist():
        for r in range(b - a):
            filled.setdefault(first + r // per, []).append((offset + r % per * length, length))
    assert sorted(filled) == list(range(len(filled)))
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64


def test_packing_keeps_every_id_once(docs):
    rows = corpus(300)
    got = pack(docs(rows), PATH, salts=3).collect()
    by_seq = {}
    for r in got:
        assert len(r.ids) == 2 * r.length
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {(r.doc_id, r.doc_tokens) for r in got} == {(d, len(ids_of(t)) + 1) for d, t in rows}
    assert sum(r.length for r in got) == sum(len(ids_of(t)) + 1 for _, t in rows)
    for i in (1000, 1100, 1299):
        own = sorted((r.start, r.ids) for r in got if r.doc_id == i)
        text = next(t for d, t in rows if d == i)
        assert np.frombuffer(b"".join(b for _, b in own), "<u2").tolist() == ids_of(text) + [1]
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    pads = [padding(sum(n for _, n in p)) for p in by_seq.values()]
    assert sum(pads) <= 2048 and padding(1024) == 0 and padding(2047) == 1


def test_packing_an_empty_table(docs):
    assert pack(docs([(1, "a")]).limit(0), PATH).collect() == []


def test_a_special_tokens_name_is_that_token():
    e, library = Encoder.of(PATH), Tokenizer.from_file(PATH)
    for text in TEXTS:
        ids, plain = np.frombuffer(next(e.encode([text])), e.dtype).tolist(), library.encode(text or "", add_special_tokens=False).ids
        assert ids == plain and (50256 in ids) == ("<|endoftext|>" in (text or ""))


def library_chars(e, texts):
    """How many characters ``e`` gives to the library for ``texts``; their ids must be the library's."""
    class Counting:
        def encode_batch_fast(self, some, **options):
            nonlocal given
            given += sum(map(len, some))
            return library.encode_batch_fast(some, **options)

    given, library, e.tokenizer = 0, e.tokenizer, Counting()
    assert [np.frombuffer(b, e.dtype).tolist() for b in e.encode(texts)] == [ids_of(t) for t in texts]
    e.tokenizer = library
    return given


def test_a_word_is_learned_once_whatever_follows_it():
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghijé") for _ in range(9)) for _ in range(100)]
    texts = [" " + "".join(r.choice(words) + r.choice([" ", ", ", ".\n", "$$$ ", "\n", "** ", ") "]) for _ in range(200)) + "end"
             for _ in range(40)]
    # each word after a space and after a line feed, and the marks; every mix of words was learned before
    assert library_chars(Encoder(PATH), texts) < 100 * 2 * 11 + 500 < sum(map(len, texts)) / 10


def test_a_full_cache_keeps_what_comes_again(monkeypatch):
    monkeypatch.setattr("snaplake.llm.tokens.SLICE", 2000)
    often = " ".join(f"common{chr(97 + i)}" for i in range(26))
    texts = ["x " + often + "".join(f" rare{i}x{k}" for k in range(100)) for i in range(40)]
    e = Encoder(PATH, cache=400)
    given = library_chars(e, texts)
    assert given < sum(map(len, texts)) - 38 * len(often) and len(e._known) <= 400


def test_long_parts_are_not_kept():
    e = Encoder(PATH)
    library_chars(e, ["y" * 100_000, "a " + "z" * 65, "short"])
    assert e._known.to_pylist() == ["a", "short"]


def test_cuts_are_where_the_library_cuts():
    some = ["a", "é", "×", "9", ",", "'", "s", " ", "\n", "\t", "\x0b", "\x1c", "\u00a0", "\u3000", "\u200b", "<|endoftext|>", "|", ">", "語"]
    texts = ["".join(x) for n in range(1, 4) for x in product(some, repeat=n)]
    r = random.Random(6)
    texts += ["".join(r.choice(some) for _ in range(r.randrange(4, 30))) for _ in range(3000)]
    e = Encoder(PATH)
    got = [np.frombuffer(b, e.dtype).tolist() for b in e.encode(texts)]
    assert got == [x.ids for x in PLAIN.encode_batch(texts, add_special_tokens=False)]


def test_columns_slices_and_empty_texts(monkeypatch):
    monkeypatch.setattr("snaplake.llm.tokens.SLICE", 30)
    monkeypatch.setattr("snaplake.llm.tokens.TOGETHER", 10)
    column = pa.array([None, "", "cut off", *TEXTS, "", None, "tail"], pa.string())[2:]
    e = Encoder(PATH)
    assert [np.frombuffer(b, e.dtype).tolist() for b in e.encode(column)] == [ids_of(t) for t in column.to_pylist()]
    assert list(e.encode(column[:0])) == [] and list(e.encode(pa.array([None, ""], pa.string()))) == [b"", b""]
