import random

import numpy as np
import pytest

import corpus_pipeline as P
from snaplake.llm.pu_classifier import quality_classifier
from .test_classifier import prose
from .test_mixing import brute as brute_mix
from .test_quality import failed, measures
from .test_simhash import brute_components, brute_fp
from .test_tokens import ids_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    top, r, rows, labels = tmp_path_factory.mktemp("sf"), random.Random(8), [], []
    for i in range(260):
        t = prose(r, r.randrange(15, 260))
        if i % 7 == 0:
            t = " ".join(w + "%%%" for w in t.split())
        if i % 11 == 0:
            t = "too short"
        rows.append((i, t, "en", ["a", "b", None, "c"][i % 4], len(t)))
        labels.append((i, int(i % 7 > 0), 0))
    rows += [(300 + i, rows[5][1], "en", "a", 1) for i in range(30)] + [(400, rows[8][1] + " x", "en", "b", 1)]
    rows += [(500, None, None, "a", None), (501, "", None, None, 0), (12, rows[12][1], "en", "a", 1), (None, prose(r, 50), "en", "c", 1),
             (502, prose(r, 9000), "en", "b", 1)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return str(top)


def test_every_stage_does_its_part_and_run_is_their_chain(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, held = docs.columns, []
    for name, stage in P.STAGES:
        path = f"{tmp_path}/{len(held)}"
        held.append(docs.collect())
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
    every, ruled, good, one, mixed = held
    same = lambda a, b: sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
    assert same(ruled, [r for r in every if not failed(measures(r.text))])  # no host fails here
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality_classifier(spark.createDataFrame(ruled, DOCS), labels, carry=["text"]).filter("predicted = 1").collect()
    assert sorted((r.doc_id or -1, r.held.text) for r in scored) == sorted((r.doc_id or -1, r.text) for r in good)
    assert len(ruled) > len(good) > 100 and not any("%%%" in r.text for r in good)
    known = [r for r in good if r.doc_id is not None]
    comp = brute_components([brute_fp(r.text) for r in known], 4)
    least = {c: min(r.doc_id for r, d in zip(known, comp) if d == c) for c in comp}
    first = {r.doc_id: r for r, c in zip(known, comp) if r.doc_id == least[c]}
    brief = lambda rows: [(r.doc_id, r.text) for r in rows]
    assert same(brief(one), brief([*first.values(), *[r for r in good if r.doc_id is None]]))
    taken = {(i, size): n // size for i, size, _, _, n in brute_mix([(r.doc_id, r.text, r.source) for r in one])}
    want = [r for r in one for _ in range(taken[-1 if r.doc_id is None else r.doc_id, len(r.text.split())])]
    assert same(mixed, want)
    pieces = [r.asDict() for r in P.run(spark, folder).collect()]
    assert sum(r["length"] for r in pieces) == sum(len(ids_of(r.text)) + 1 for r in mixed)
    big = [r for r in pieces if r["doc_id"] == 502]
    copies = sum(r.doc_id == 502 for r in mixed)
    for start in {r["start"] for r in big}:
        own = [r for r in big if r["start"] == start]
        ids = (ids_of(next(r.text for r in mixed if r.doc_id == 502)) + [1])[start:start + own[0]["length"]]
        assert len(own) == copies and all(np.frombuffer(r["ids"], "<u2").tolist() == ids for r in own)
    sequences = {}
    for r in pieces:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048


def test_an_empty_table_passes_through(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert P.packed_sequences(spark, docs, folder).collect() == []


def test_an_id_with_several_texts_loses_only_the_copies(spark):
    r = random.Random(3)
    a, b, c, d = (prose(r, 120) for _ in range(4))
    near = " ".join(d.split()[:-1])
    assert bin(brute_fp(d) ^ brute_fp(near)).count("1") <= 4
    rows = [(7, a, "x"), (9, a, "x"), (3, b, "x"), (7, b, "x"), (7, b, "x"), (7, c, "x"), (7, c, "y"), (5, d, "x"), (5, near, "x"), (None, a, "x")]
    found = set()
    for parts in (1, 4):
        docs = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], DOCS).repartition(parts)
        got = sorted(((x.doc_id or -1, x.text, x.source) for x in P.one_of_each_group(spark, docs, "").collect()), key=str)
        found.add(tuple(got))
    assert len(found) == 1
    texts = [x[:2] for x in got]
    assert sorted(x for x in texts if x[0] != 5) == sorted([(7, a), (3, b), (7, c), (-1, a)])
    assert [x[1] in (d, near) for x in texts if x[0] == 5] == [True]
