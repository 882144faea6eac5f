import re

from snaplake.llm.license_scan import PHRASES, TEMPLATES, license_scan

MIT = TEMPLATES[1][1]


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def base(text):
    words, places, labels = words_of(text), [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


FILL = " ".join(f"filler{i}" for i in range(400))
TEXTS = [None, "", "!!", "MIT License", "The MIT license; the Apache-License and GNU General Public License, MIT LICENSE",
         "general public", "public license general public license", "mit  license" * 40, f"{FILL} {MIT} {FILL}",
         "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", "É ẞ MİT license", "x" * 20000, "mit\x7flicense mit_license"]


def test_base_is_exact(docs):
    rows = list(enumerate(TEXTS)) + [(4, "Mit license"), (4, "Mit license"), (None, "apache license")]
    got = license_scan(docs(rows)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, str(x))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(
        ((i, *base(t)) for i, t in rows), key=key)
    for r in got:
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def scan(docs, *texts):
    return {r.doc_id: r for r in license_scan(docs(list(enumerate(texts)))).collect()}


def test_spans_survive_small_changes_and_refuse_scattered_words(docs):
    w = MIT.split()
    inserted = " ".join(w[:12] + ["really"] + w[12:30] + w[31:])
    scattered = " ".join(" ".join(w[i:i + 3]) + " " + " ".join(f"z{i}y{k}" for k in range(30)) for i in range(0, len(w) - 3, 3))
    got = scan(docs, f"{FILL} {MIT}, and more", f"{FILL} {inserted} {FILL}", scattered, " ".join(w[:15]),
               "Licensed under CC BY-NC 4.0.", f"{MIT} {FILL} {MIT}", " ".join(reversed(w)))
    assert got[0].labels == "mit" and got[0].score == 1.0 and [(s["first"], s["last"]) for s in got[0].spans] == [(400, 400 + len(words_of(MIT)) - 1)]
    assert got[1].labels == "mit" and 0.8 <= got[1].score < 1
    assert (got[2].labels, got[3].labels, got[6].labels) == ("", "", "")
    assert got[4].labels == "cc-by-nc" and got[4].base_labels == ""
    assert [s["label"] for s in got[5].spans] == ["mit", "mit"]


def test_empty_table(docs):
    assert license_scan(docs([(1, "a")]).limit(0)).collect() == []
