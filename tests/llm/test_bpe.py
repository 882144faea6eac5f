import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snaplake.llm.bpe import Bpe, bpe_decode, bpe_encode, bpe_round_trip, byte_characters
from snaplake.llm.queries import op11_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
TEXTS = [None, "", " ", "\n", "a  b", "don't stop, we'll go; I'm.", "x.\nY \n z\t\tq  ", "  lead", "tail  ", "é  ü　 ß",
         "a <|endoftext|> b", "<|endoftext|><|endoftext|>x", "<|endoftext", "1,234.5 ²³ x², y³.", "日本語 の テキスト。",
         "\x1c \x1d x", "a   b", "!!! ??? ...", "aaaaaaa aaaaaaaaaaaaa", "� x ͸ ", "\U0001F600" * 9, "\x00 \x7f"]


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab Z9'.,!\n\t é 　日²́-s<|>"), max_size=40))
def test_ids_and_text_are_the_librarys(text):
    bpe = Bpe.of(PATH)
    ids = next(bpe.encode([text]))
    assert ids.tolist() == ids_of(text)
    assert bpe.decode(ids) == PLAIN.decode(ids_of(text), skip_special_tokens=False) == text


def test_any_characters_special_tokens_and_a_small_cache():
    r = random.Random(3)
    odd = ["".join(chr(r.choice([r.randint(32, 126), r.randint(128, 0x2FFF), r.randint(0xE000, 0x10FFFF)])) for _ in range(60))
           for _ in range(300)]
    texts = TEXTS + odd + TEXTS
    assert [x.tolist() for x in Bpe(PATH, cache=50).encode(texts)] == [ids_of(t) for t in texts]
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    assert [x.tolist() for x in Bpe.of(PATH, special=False).encode(TEXTS)] == [
        plain.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def test_long_words_merge_as_short_ones_do():
    r = random.Random(5)
    for text in ("a" * 100_001, "ab" * 30_000, "".join(r.choice("abcdefghij") for _ in range(100_000))):
        assert next(Bpe.of(PATH).encode([text])).tolist() == ids_of(text)


def test_decoding_any_ids_is_the_librarys():
    r = np.random.default_rng(1)
    for _ in range(50):
        ids = r.integers(0, 50257, 30)
        assert Bpe.of(PATH).decode(ids) == PLAIN.decode(ids.tolist(), skip_special_tokens=False)
    assert Bpe.of(PATH).decode(np.array([64, 60_000, -1, 65])) == PLAIN.decode([64, 65])


def test_byte_characters_are_one_each():
    chars = byte_characters()
    assert len(set(chars)) == 256 and chars[65] == "A" and chars[32] == "Ġ"


def test_files_that_do_more_are_refused():
    with pytest.raises(ValueError):
        Bpe(public_tokenizers.path("word_bpe_49k.json"))


def test_a_table_with_odd_rows(spark, docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "repeated row"), (3, "repeated row"), (None, "no id"), (99, "word " * 60_000)]
    found = bpe_round_trip(docs(rows), PATH).collect()
    want = sorted([(i, ids_of(t), t or "") for i, t in rows], key=str)
    assert sorted([(r.doc_id, r.ids, r.decoded) for r in found], key=str) == want
    assert bpe_round_trip(docs(rows).limit(0), PATH).count() == 0
    nothing = spark.range(1).select(F.lit(None).cast("string").alias("t"), F.lit(None).cast("array<int>").alias("i"))
    assert nothing.select(bpe_encode(F.col("t"), PATH), bpe_decode(F.col("i"), PATH)).first()[:] == ([], None)


def test_the_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = ids_of(r.text)
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(PLAIN.decode(ids, skip_special_tokens=False))))
    found = op11_bpe(spark, sf)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # each text is coded once
