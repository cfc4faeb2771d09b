import random
import re

from floodmark.llm import license as scans

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, labels = [], set()
    for phrase, label in scans.PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        at += found
        labels |= {label} if found else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_places_as_brute_force(spark):
    rng = random.Random(1)
    parts = ["CC BY", "cc-by", "cc", "by", "General Public License", "general", "public", "license", "All rights reserved.", "rights", "été", "Éa", "x1", "_", "\n", "cc by by cc by"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    rows += [(500, None), (501, ""), (502, "..."), (503, "cc by " * 30_000), (1, "all rights reserved"), (504, rows[4][1]), (4, rows[4][1]), (None, "cc by")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "'a' as label")
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scans.scan(docs).collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=str)


def test_templates_with_changed_words(spark):
    mit = scans.TEMPLATES["mit"].split()
    near = mit[:5] + ["quite"] + mit[5:9] + mit[10:]
    rows = [
        (1, "intro words here " + " ".join(mit) + " and more"),
        (2, "intro " + ", ".join(near).upper()),
        (3, "permission is hereby granted by the king"),
        (4, "Licensed under the Apache License, Version 2.0."),
        (5, "Licensed under CC BY-NC 4.0."),
        (6, "nothing of the kind"),
    ]
    got = {r.doc_id: r for r in scans.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "mit" and got[1].score == 1.0 and [(s.first, s.end) for s in got[1].spans] == [(3, 3 + len(mit))]
    assert got[2].labels == "mit" and 0.9 < got[2].score < 1
    assert got[3].labels == "" and got[3].score == 0 and got[3].spans is None
    assert got[4].labels == "apache-2" and got[5].labels == "cc-by,cc-by-nc-4" and got[5].base_labels == "cc-by"
    assert got[6].labels == "" and got[6].n_base == 0


def test_empty_table(spark):
    assert scans.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
