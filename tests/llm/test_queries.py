"""The registered queries on the given tables: against SQL, or against the contract where SQL can't say it."""

import os
import sys
import zlib

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from check_oracle import compare, duck_connect  # noqa: E402

from snaplake.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

from .test_simhash import brute_components, brute_fp  # noqa: E402
from .test_tokens import ids_of  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    line, ok = compare(spark, duck_connect(SF), name, QUERIES[name], ORACLE_SQL[name], SF)
    assert ok, line


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_fingerprints_and_components(spark, texts):
    ids = sorted(texts)
    fps = [brute_fp(texts[i]) for i in ids]
    comp = brute_components(fps, 4)
    least = {c: min(i for i, d in zip(ids, comp) if d == c) for c in comp}
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op2_simhash_dedup"](spark, SF).collect()}
    assert got == {(i, f"{f:016x}", least[c]) for i, f, c in zip(ids, fps, comp)}


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_stored_tokens(spark, texts):
    at, want = 0, set()
    for i in sorted(texts):
        ids = ids_of(texts[i]) + [0]
        want.add((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert {tuple(r) for r in QUERIES["op8_token_store"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()} == want


def test_packed_pieces(spark, texts):
    ids = {i: ids_of(t) + [1] for i, t in texts.items()}
    rows, sequences = QUERIES["op7_packing"](spark, SF).collect(), {}
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == crc(ids[r.doc_id][r.start:r.start + r.length])
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_classifier_on_held_out_labels(spark):
    got = {r.doc_id: r for r in QUERIES["op10_quality_classifier"](spark, "/root/testdata/sf0.01").collect()}
    labels = [r for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect() if got[r.doc_id].held_out]
    assert len(labels) > 50 and sum(got[r.doc_id].predicted == r.quality for r in labels) >= 0.93 * len(labels)
