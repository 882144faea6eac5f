import hashlib
import math
import random
import re

from snaplake.llm.mixing import mix, mixed_documents


def brute(rows, weights=(3, 1, 2), total=1.5, limit=2.0, seed=7):
    """One source after the other, excess handed out again until nobody is over."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    full = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in names}
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), total * sum(size), set(names)
    while open_ and left > 1e-9:
        share = left / sum(w[s] for s in open_)
        for s in open_:
            target[s] += share * w[s]
        left = sum(max(0, target[s] - limit * full[s]) for s in open_)
        over = {s for s in open_ if target[s] >= limit * full[s]}
        target.update({s: limit * full[s] for s in over})
        open_ -= over
    out = []
    for s in names:
        own = []
        for (i, t, src), n in zip(rows, size):
            if src == s:
                u = (int(hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:13], 16) + 1) / 2 ** 52
                solid = len(re.sub(r"[\x20\x09-\x0D]", "", t or ""))
                q = max(0.05, sum(c.isalpha() for c in t or "") / solid if solid else 0.05)
                own.append((-math.log(u) / q, n, -1 if i is None else i))
        epochs = math.floor(target[s] / full[s] + 1e-12) if full[s] else 0
        rest, ahead = target[s] - epochs * full[s], 0
        for _, n, i in sorted(own):
            out.append((i, n, full[s], round(target[s], 6), n * (epochs + (n > 0 and ahead + n / 2 <= rest))))
            ahead += n
    return sorted(out)


def table(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken)
                  for r in df.collect())


def rows(n=400):
    r = random.Random(2)
    names = ["src1", "src10", "src2", "é", None, "Z", "a", "tiny", "blank", ""]
    out = [(i, " ".join("w%d," % r.randrange(99) for _ in range(int(r.paretovariate(1.2) * 8) % 900)),
            names[0] if i % 3 == 0 else names[r.randrange(7)]) for i in range(n)]
    return out + [(1000, "one", "tiny"), (1001, None, "blank"), (1002, " \n", "blank"), (1003, "", None), (1004, "x y", "")]


def test_equals_brute_force_and_reruns_agree(docs):
    got = table(mix(docs(rows())))
    assert got == brute(rows())
    assert got == table(mix(docs(rows(), parts=7)))


def test_epochs_come_first_and_targets_are_near(docs):
    got = mix(docs(rows())).collect()
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1e-6
        assert max(r.copies for r in own) - min(r.copies for r in own) <= 1 and max(r.copies for r in own) <= 2


def test_repeated_rows_nulls_and_empty(docs):
    twice = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "d e", "s"), (None, None, None)]
    assert table(mix(docs(twice))) == brute(twice)
    assert mix(docs([(1, "a")]).limit(0)).collect() == []


def test_documents_come_back_as_often_as_they_are_taken(docs):
    d = docs(rows(100))
    taken = {r.doc_id: r.copies for r in mix(d).collect()}
    out = mixed_documents(d)
    assert out.columns == d.columns
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in taken.items() if v}


def test_ranges_of_the_key_are_even_under_a_small_weight(spark):
    from pyspark.sql import functions as F

    from snaplake.llm.common import unit_hash
    from snaplake.llm.mixing import BUCKETS, key_ranges

    for w in (0.05, 1.0):
        rows = spark.range(100_000).withColumn("w", F.when(F.col("id") % 3 == 0, F.lit(0.4)).otherwise(F.lit(w)))
        rows = rows.withColumn("key", -F.log(unit_hash(F.col("id"), 7)) / F.col("w"))
        most = rows.groupBy(key_ranges(rows).alias("r")).count().agg(F.max("count"), F.count("r")).first()
        assert most[0] < 300 and most[1] > BUCKETS * 0.9  # of 100,000 rows, 24 a range are even


def test_many_sources_get_the_targets_of_one_window(spark):
    from snaplake.llm.mixing import source_targets

    r = random.Random(9)
    sizes = [(f"host{i}" if i else None, r.randrange(1, 3000) if i % 7 else 0) for i in range(900)]
    got = {x.source: x.target for x in source_targets(spark.createDataFrame(sizes, "source string, source_size long").repartition(9), (3, 1, 2), 1.5, 2.0).collect()}
    names = sorted((s for s, _ in sizes), key=lambda s: (s is None, s or ""))
    w, full, size = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, {s: 2.0 * n for s, n in sizes}, dict(sizes)
    low, high = 0.0, 1e9  # the level, by halving
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(full[s], w[s] * mid) for s in names) < 1.5 * sum(size.values()) else (low, mid)
    assert got.keys() == full.keys() and all(abs(got[s] - min(full[s], w[s] * low)) < 1e-6 for s in names)
