import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snaplake.llm import alignment
from snaplake.llm.alignment import Aligner, _documents, align_tokenizers, packed, unpacked, written
from snaplake.llm.bpe import byte_characters
from snaplake.llm.common import materialise
from snaplake.llm.queries import op13_alignment
from snaplake.llm.ragged import Csr, counted

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TA = Tokenizer.from_file(A)
TA.encode_special_tokens = True
TB = sentencepiece.SentencePieceProcessor(model_file=B)
BYTE = {c: b for b, c in enumerate(byte_characters())}
TEXTS = [None, "", " ", "\n", "a  b", "don't stop, we'll go; I'm.", "x.\nY \n z\t\tq  ", "  lead", "tail ", "tail  ", "é  ü　 ß",
         "<|endoftext|> <s> </s> <unk> <0x0A>", "1,234.5 ²³ x², y³.", "日本語 の テキスト。", "a ▁ b", "▁", "x▁y", "\x00 a", "a   b",
         "!!! ??? ...", "\U0001F600 \U0001F600x", "aaaaaaa aaaaaaaaaaaaa", "don't stop, we'll go; I'm."]


def spelled(text):
    """(A ids, A bytes, B ids, B bytes), nothing if the bytes differ."""
    if not text:
        return [], [], [], []
    a = TA.encode(" " + text, add_special_tokens=False)
    b = TB.encode(text)
    a_bytes = [bytes(BYTE[c] for c in t) for t in a.tokens]
    b_bytes = [bytes([int(p[3:5], 16)]) if TB.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in zip(b, map(TB.id_to_piece, b))]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return [], [], [], []
    return a.ids, a_bytes, b, b_bytes


def groups_of(text):
    """[(A ids, B ids)] of each group and the number of overlapping pairs, byte by byte from the left."""
    a, a_bytes, b, b_bytes = spelled(text)
    groups, overlaps, i, j, a_end, b_end = [], 0, 0, 0, 0, 0
    own = ([], [])
    while i < len(a) or j < len(b):
        if a_end == b_end and own[0]:
            groups.append(own)
            own = ([], [])
        if a_end <= b_end and i < len(a):
            together = a_end == b_end
            own[0].append(a[i])
            a_end += len(a_bytes[i])
            i += 1
            if together:
                own[1].append(b[j])
                b_end += len(b_bytes[j])
                j += 1
        else:
            own[1].append(b[j])
            b_end += len(b_bytes[j])
            j += 1
        overlaps += 1  # the newer token meets the one that is still open on the other side
    return groups + ([own] if own[0] else []), overlaps


def brute(rows):
    found = [(i, *groups_of(t)) for i, t in rows]
    held = Counter()
    for _, groups, _ in found:
        held.update({(a, b) for g in groups for a in g[0] for b in g[1]})
    best = defaultdict(int)
    for (a, _), c in held.items():
        best[a] = max(best[a], c)
    out = []
    for i, groups, overlaps in found:
        links = [(a, b) for g in groups for a in g[0] for b in g[1]]
        out.append((i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), overlaps,
                    sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
                    ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups)))
    return sorted(out, key=str)


def test_a_product_is_numpys():
    r = np.random.default_rng(0)
    for shape in ((1, 1, 1), (20, 30, 7), (5, 0, 5), (0, 4, 3)):
        x, y = r.integers(0, 4, shape[:2]) * (r.random(shape[:2]) < 0.3), r.integers(0, 4, shape[1:]) * (r.random(shape[1:]) < 0.3)

        def csr(m):
            rows, columns = np.nonzero(m)
            return Csr.of(rows, columns, m.shape, m[rows, columns])

        def dense(c, n):
            m = np.zeros((c.n_rows, n), int)
            m[c.rows(), c.columns] = c.values
            return m
        assert (dense(csr(x).product(csr(y)), shape[2]) == x @ y).all()
        assert (dense(csr(x).transposed(), shape[0]) == x.T).all()
        v = r.integers(0, 9, shape[1])
        assert (csr(x).times_vector(v) == x @ v).all()
    assert [a.tolist() for a in counted(np.array([5, 1, 5]), np.array([2, 3, 4]))] == [[1, 5], [3, 6]]


def test_blocks_of_a_product_do_not_change_it(monkeypatch):
    r = np.random.default_rng(1)
    x = Csr.of(r.integers(0, 50, 400), r.integers(0, 40, 400), (50, 40))
    whole = x.product(x.transposed())
    monkeypatch.setattr("snaplake.llm.ragged.BLOCK", 3)
    small = x.product(x.transposed())
    assert all((getattr(whole, f) == getattr(small, f)).all() for f in ("starts", "columns", "values"))


def written_out(aligner, texts):
    """Each text's alignment, from a chunk's numbers."""
    per_text, parts, _, n_tokens, ids, marks, *_ = map(unpacked, aligner.chunk(texts)["data"])
    spelled, ends = written(ids, marks, n_tokens), np.concatenate(([0], np.cumsum(per_text)))
    return ["".join(spelled[p] for p in parts[a:b])[:-1] for a, b in zip(ends, ends[1:])]


def test_numbers_take_the_bytes_they_need():
    for top, width in ((0, 1), (255, 1), (256, 2), (70_000, 4), (1 << 40, 8)):
        data = packed(np.array([0, top]))
        assert data[0] == width and unpacked(data).tolist() == [0, top]
    assert unpacked(packed(np.zeros(0, np.int64))).tolist() == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab Z9'.,!\n\t é 　日²́-s▁<|>"), max_size=30))
def test_parts_of_any_text_align_as_the_whole(text):
    assert written_out(Aligner.of(A, B), [text]) == [brute([(0, text)])[0][8]]


def test_a_table_with_odd_rows(spark, docs, monkeypatch):
    r = random.Random(4)
    rows = list(enumerate(TEXTS)) + [(3, "repeated row"), (3, "repeated row"), (None, "no id")]
    rows += [(50 + i, " ".join(r.choice(["the", "there", "theirs,", "été", "qzx'"]) for _ in range(r.randint(0, 30)))) for i in range(40)]
    rows += [(200, "xyz " * 3000)]
    table = docs(rows, parts=4)
    found = align_tokenizers(table, A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_best", "count_sum", "groups"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)
    assert align_tokenizers(table.limit(0), A, B).count() == 0
    nothing = align_tokenizers(docs([(1, None), (2, "")]), A, B)
    assert sorted(map(tuple, nothing.collect())) == [(1, *[0] * 7, ""), (2, *[0] * 7, "")]


def test_chunks_and_a_small_cache_do_not_change_it(monkeypatch):
    aligner = Aligner(A, B, cache=60)
    monkeypatch.setattr("snaplake.llm.alignment.SLICE", 10)
    for some in (TEXTS, TEXTS[::-1], TEXTS[5:9]):
        assert written_out(aligner, [t or "" for t in some]) == [
            ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups_of(t)[0]) for t in some]


def test_the_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    want = brute([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
    found = op13_alignment(spark, sf)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == [
        (*w[:5], *w[6:8], hashlib.sha256(w[8].encode()).hexdigest() if w[8] else "") for w in want]


def chunk_tables(texts):
    """What a chunk's task gets: the chunk, and its pairs with made-up counts."""
    row = Aligner.of(A, B).chunk(texts)
    n = len(row["ids"])
    own = pa.table({"keys": pa.array([list(range(len(texts)))]), "data": pa.array([row["data"]], pa.list_(pa.binary()))})
    return own, pa.table({"place": pa.array(range(n), pa.int32()), "count": pa.array(range(n), pa.int64()), "best": pa.array([i % 2 == 0 for i in range(n)])})


def test_a_chunks_rows_are_made_in_little_memory_and_sent_in_batches(monkeypatch):
    r = random.Random(7)
    words = ["".join(r.choice(["th", "er", "on", "an", "re", "é", "x."]) for _ in range(r.randint(1, 6))) for _ in range(40_000)]
    texts = [" ".join(r.choices(words, k=500)) for _ in range(600)]
    own, pairs = chunk_tables(texts)
    tracemalloc.start()
    found = _documents(own, pairs, "doc_id")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not alignment._WORKER  # no tokenizer is held beside it
    assert peak < 12 * sum(map(len, texts))
    assert found.num_rows == 600 and max(b.nbytes for b in found.to_batches()) < 2 * alignment.BATCH
    monkeypatch.setattr(alignment, "TOKENS", 7)
    monkeypatch.setattr(alignment, "BATCH", 50)
    own, pairs = chunk_tables(["", *texts[:9], "", "tail "])
    again = _documents(own, pairs, "doc_id")
    assert again.column("groups").to_pylist() == ["", *found.column("groups").to_pylist()[:9], "", brute([(0, "tail ")])[0][8]]
    assert len(again.to_batches()) > 9


def test_row_groups_of_chunks_hold_few_rows(spark):
    kept = materialise(spark.range(0, 11, 1, 1), "alignment-groups", 4)
    held = pq.ParquetFile(kept.inputFiles()[0].removeprefix("file://")).metadata
    assert [held.row_group(i).num_rows for i in range(held.num_row_groups)] == [4, 4, 3]
    assert kept.count() == 11
