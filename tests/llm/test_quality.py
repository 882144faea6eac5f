import random
import re

from snaplake.llm.quality_rules import quality_rules, rejected_hosts

TEXTS = [None, "", " \t", "one", "a b c d e f g h i j", "a b c d e " * 4, "x " * 30, "same line\nsame line\n \n\nsame line\r\n",
         "# * $ % & | < > #*", "é 日本 ß\x0bz\x0cq\x1cr", "word " * 9, "\n".join(["l1 w", "l2 w"] * 50), "q" * 9000,
         " ".join(f"w{i % 701}" for i in range(9000))]


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, covered = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(p + k for p in places for k in range(5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def failed(m):
    return m[0] < 10 or 100 * m[4] > 20 * m[0]


def test_measures_and_base_rules(docs):
    r = random.Random(4)
    rows = list(enumerate(TEXTS)) + [(100 + i, " ".join(r.choice("abcd") for _ in range(r.randrange(60)))) for i in range(150)]
    rows += [(3, "one"), (3, "one"), (None, "null id"), (900, "no host " * 2, None)]
    got = quality_rules(docs(rows)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) for x in got), key=key) == sorted(
        ((row[0], *measures(row[1]), failed(measures(row[1]))) for row in rows), key=key)


def test_empty_table(docs):
    assert quality_rules(docs([(1, "a")]).limit(0)).collect() == []


def good(i):
    return " ".join(f"word{i}x{k}" for k in range(30))


def test_a_bad_host_loses_its_good_documents_and_small_ones_get_the_doubt(docs):
    bad = "a b c d e f " * 5
    rows = [(i, bad if i % 10 else good(i), "spam") for i in range(200)]
    rows += [(1000 + i, good(i) if i % 10 else bad, "fine") for i in range(400)]
    rows += [(2000 + i, good(i), f"ok{i % 20}") for i in range(300)]
    rows += [(3000, bad, "tiny"), (3001, good(1), "tiny"), (3002, good(2), None), (3003, bad, None)]
    got = {x.doc_id: x for x in quality_rules(docs(rows)).collect()}
    assert not any(got[i].kept for i in range(200)) and all(got[i].host_failed for i in range(200))
    assert all(got[1000 + i].kept == (i % 10 > 0) for i in range(400))
    assert all(got[2000 + i].kept for i in range(300))
    assert [got[i].kept for i in (3000, 3001, 3002, 3003)] == [False, True, True, False]


def test_repeated_lines_are_counted_against_lines_and_speak_for_the_host(docs):
    def page(i, copies):  # between long lines a short one that repeats: few of the words, many of the lines
        lines = [" ".join(f"w{i}x{k}x{j}" for j in range(12)) + ("\nread more" if k < copies else "") for k in range(20)]
        return "\n".join(lines)
    rows = [(i, page(i, 20), "copies") for i in range(50)] + [(100 + i, page(100 + i, 2), "fine") for i in range(50)]
    rows += [(200 + i, good(i), f"ok{i % 20}") for i in range(300)]
    got = {x.doc_id: x for x in quality_rules(docs(rows)).collect()}
    assert got[0].n_dup_lines == 19 and not got[0].base_failed
    assert all(got[i].host_failed and not got[i].kept for i in range(50))
    assert all(got[i].kept for i in [*range(100, 150), *range(200, 500)])


def test_prior_shrinks_by_the_spread_of_the_hosts(spark):
    alike = spark.createDataFrame([(f"h{i}", 50, 20 + i % 3) for i in range(40)] + [("new", 1, 1)], "host string, n long, r long")
    assert rejected_hosts(alike, "host", ["r"], 0.5).collect() == []
    apart = spark.createDataFrame([(f"h{i}", 50, 50 * (i % 2)) for i in range(40)] + [("new", 3, 3)], "host string, n long, r long")
    assert {x.host for x in rejected_hosts(apart, "host", ["r"], 0.5).collect()} == {f"h{i}" for i in range(1, 40, 2)} | {"new"}
    none = spark.createDataFrame([], "host string, n long, r long")
    assert rejected_hosts(none, "host", ["r"], 0.5).collect() == []


def test_carried_columns_come_back(docs):
    d = docs(list(enumerate(TEXTS)))
    out = quality_rules(d, carry=d.columns).select("held.*")
    assert out.columns == d.columns and out.count() == len(TEXTS)
