import random
import zlib

import numpy as np
import pytest

from snaplake.llm.pu_classifier import estimate_prior, features, fit_nn_pu, nn_risk, quality_classifier

LABELS = "doc_id long, quality int, toxic int, text string"


def prose(r, n):
    return " ".join(r.choice(["the", "sea", "was", "calm,", "and", "light", "fell", "on", "stones.", "we", "went"]) + r.choice(["", "", "ly"]) for _ in range(n))


def corpus(n=1200, seed=1):
    r, rows, labels, truth = random.Random(seed), [], [], {}
    for i in range(n):
        good = r.random() < 0.8
        t = prose(r, r.randrange(5, 200))
        if not good:
            t = [" | ".join(t.split()), " ".join(w + "%%%" for w in t.split()), " ".join(w + " " + w + " " + w for w in t.split()), t.upper() + "!!"][i % 4]
        rows.append((i, t))
        truth[i] = good
        if r.random() < 0.5:
            labels.append((i, int(good), 0, "x"))
    return rows, labels, truth


def test_held_out_rows_are_told_apart_and_never_learned(docs, spark):
    rows, labels, truth = corpus()
    got = quality_classifier(docs(rows), spark.createDataFrame(labels, LABELS)).collect()
    out = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in out} == {r.doc_id for r in got if r.held_out} and len(got) == len(rows)
    right = np.mean([r.predicted == truth[r.doc_id] for r in out])
    assert right > 0.95 and all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t, x) for i, q, t, x in labels]
    again = quality_classifier(docs(rows, parts=5), spark.createDataFrame(turned, LABELS)).collect()
    assert {(r.doc_id, r.score) for r in again} == {(r.doc_id, r.score) for r in got}


def test_odd_rows_and_tables(docs, spark):
    rows, labels, _ = corpus(300)
    odd = rows + [(9000, None), (9001, ""), (9002, "y " * 100_000), (None, "null id"), (5, rows[5][1]), (5, rows[5][1])]
    twice = labels + [(5, 0, None, None), (5, 1, None, None), (None, 1, 0, "x"), (6, None, 0, "x")]
    got = quality_classifier(docs(odd), spark.createDataFrame(twice, LABELS)).collect()
    assert len(got) == len(odd) and len({r.score for r in got if r.doc_id == 5}) == 1
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    none = quality_classifier(docs(rows), spark.createDataFrame([], LABELS)).collect()
    assert {(r.score, r.predicted) for r in none} == {(1.0, 1)}  # nothing speaks against a document
    assert quality_classifier(docs(rows).limit(0), spark.createDataFrame(labels, LABELS)).collect() == []


def test_the_sample_is_bounded_under_repeated_ids_and_rows(docs, spark, monkeypatch):
    from snaplake.llm import pu_classifier

    rows, labels, _ = corpus(400)
    hot = next(i for i, _, *_ in rows if zlib.crc32(str(i).encode()) % 4 != 2)
    many = rows + [(hot, "one text")] * 4000 + [(hot, f"text {i} of a hot id") for i in range(4000)]
    sizes = []
    monkeypatch.setattr(pu_classifier, "fit", lambda p, u: sizes.append((len(p), len(u))))
    pu_classifier.train(docs(many), spark.createDataFrame(labels + [(hot, 1, 0, "x"), (10 ** 9, 1, 0, "no document")], LABELS), sample=100)
    assert 0 < sizes[0][0] < 200 and 50 < sizes[0][1] < 200


@pytest.mark.parametrize("prior", [0.5, 0.85])
def test_risk_and_prior(prior):
    r = np.random.default_rng(3)
    good = lambda n: np.hstack([r.normal(2, 1, (n, 2)), np.ones((n, 1))])
    bad = lambda n: np.hstack([r.normal(-2, 1, (n, 2)), np.ones((n, 1))])
    p, k = good(2000), int(3000 * prior)
    u = np.vstack([good(k), bad(3000 - k)])[r.permutation(3000)]
    assert abs(estimate_prior(p, u) - prior) < 0.06
    w = fit_nn_pu(p, u, prior)
    assert (good(500) @ w > 0).mean() > 0.97 and (bad(500) @ w < 0).mean() > 0.97
    assert nn_risk(w, p, u, prior)[1] > -0.05 and sum(nn_risk(w, p, u, prior)) < sum(nn_risk(np.zeros(3), p, u, prior))


def test_features_are_shares():
    for t in (None, b"", b" ", b"a a a", b"%|!", "é日".encode(), b"x\nx\ny"):
        assert all(0 <= x <= 1 for x in features(t)) and len(features(t)) == len(features(b""))
