import random
import re

import numpy as np
import pytest
import xxhash

from snaplake.llm import simhash as S


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps, max_bits):
    ids = list(range(len(fps)))
    parent = ids[:]

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in ids:
        for j in ids[:i]:
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in ids]


TEXTS = [None, "", " \t\n", "one", "One two", "a b c d", "A B C D e", "à É ß ſ", "x" * 5000,
         " ".join(f"w{i % 97}" for i in range(20000)), "a b c d a b c d a b c d", "sep\x0bby\x0call\x0dkinds\x1cof"]


def test_fingerprint_matches_a_plain_count():
    for t in TEXTS:
        assert S.fingerprint(None if t is None else t.encode()) == brute_fp(t)


def test_documents_end_to_end(docs):
    r = random.Random(1)
    base = [" ".join(r.choice("lorem ipsum dolor sit amet elit sed do".split()) + str(r.randrange(30)) for _ in range(300))
            for _ in range(8)]
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for k in range(60):
        words = base[k % 8].split()
        for _ in range(k % 4):
            words[r.randrange(300)] = "changed"
        rows.append((100 + k, " ".join(words)))
    rows += [(500, base[0]), (500, base[0]), (None, base[0])]
    got = S.simhash_dedup(docs(rows)).collect()
    assert len(got) == len(rows)
    numbered = [x for x in rows if x[0] is not None]
    fps = [brute_fp(t) for _, t in numbered]
    comp = brute_components(fps, 4)
    ids = [x[0] for x in numbered]
    least = {c: min(i for i, d in zip(ids, comp) if d == c) for c in comp}
    want = {(i, f, least[c]) for i, f, c in zip(ids, fps, comp)}
    assert {(x.doc_id, x.fp % 2 ** 64, x.component_id) for x in got if x.doc_id is not None} == want
    assert [x.component_id for x in got if x.doc_id is None] == [least[comp[ids.index(500)]]]


def test_empty_table(docs, spark):
    assert S.simhash_dedup(docs([(1, "a")]).limit(0)).collect() == []


@pytest.mark.parametrize("max_bits,limit", [(4, 32768), (4, 3), (4, 12), (3, 3), (2, 2), (0, 32768)])
def test_links_are_exact_and_complete(spark, max_bits, limit):
    rng = np.random.default_rng(max_bits * 100 + limit)
    fps = []
    for _ in range(12):
        seed = int(rng.integers(0, 2 ** 63)) * 2 + 1
        for _ in range(15):
            fps.append(seed ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 6)), replace=False)))
    fps = sorted(set(fps))
    reps = spark.createDataFrame([(S._signed(f), i) for i, f in enumerate(fps)], "fp long, rep long").repartition(5)
    links = S.fingerprint_links(reps, max_bits, limit).collect()
    assert all(bin(fps[x.src] ^ fps[x.dst]).count("1") <= max_bits for x in links)
    found = {x.node: x.component for x in S.connected_components(S.fingerprint_links(reps, max_bits, limit)).collect()}
    assert [found.get(i, i) for i in range(len(fps))] == brute_components(fps, max_bits)


def test_forest_spans_a_long_list():
    rng = np.random.default_rng(5)
    fps = np.unique(rng.integers(0, 64, 50).astype(np.uint64))
    rules, at = S._list_rules(4), S._masks(4).index((1, 2, 3, 4))
    links = S._forest(fps, np.arange(len(fps)), at, 4, rules, tile=7)
    assert len(links) <= len(fps) - 1
