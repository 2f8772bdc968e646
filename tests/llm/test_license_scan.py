import math
import random
import re

import pytest

from postingloom.llm import license_scan as L
from postingloom.llm.queries import op13_license_scan

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain_bases(words):
    found = []
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    return sorted(found)


def plain_templates(words, share, drift):
    """Every template at every place."""
    best = []
    for template in L.TEMPLATES:
        passage, top = template.passage.split(), None
        for at in range(-len(passage) - drift, len(words) + drift):
            near = lambda q: words[max(0, at + q - drift) : max(0, at + q + drift + 1)]  # noqa: E731, B023
            n = sum(word in near(q) for q, word in enumerate(passage))
            within = words[max(0, at - drift) : max(0, at + len(passage) + drift)]
            whole = all(any(within[k : k + len(p)] == p for k in range(len(within))) for p in map(str.split, template.phrases))
            if n >= math.ceil(share * len(passage)) and whole and (top is None or n > top[0]):
                top = (n, at)
        if top:
            best.append((template.label, top[1], top[0] / len(passage)))
    return best


def texts(n, seed):
    rng = random.Random(seed)
    made = [None, "", "CC BY", "all RIGHTS reserved all rights  reserved.", "general public", "cc-by-nc", "cc byé", "KK mit license"]
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(1, 4)):
            passage = rng.choice(L.TEMPLATES).passage.split()
            for _ in range(rng.randrange(5)):
                k = rng.randrange(len(passage))
                edit = rng.randrange(4)
                if edit == 0:
                    passage.insert(k, "extra")
                elif edit == 1 and len(passage) > 2:
                    del passage[k]
                elif edit == 2:
                    passage[k] = "other"
                else:
                    passage = passage[k:] if rng.random() < 0.3 else passage
                if not passage:
                    passage = ["license"]
            words += passage + rng.choice([[], ["lorem"] * rng.randrange(9), ["the", "license"]])
        made.append(rng.choice([" ", "\n", ", "]).join(w.upper() if rng.random() < 0.1 else w for w in words))
    return made


@pytest.mark.parametrize("share, drift", [(0.8, 2), (0.5, 0)])
def test_against_every_place(spark, share, drift):
    given = texts(60, int(share * 10))
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in enumerate(given)], "doc_id int, text string, n_words int, bases string")
    found = {r.doc_id: r for r in L.scan(frame.repartition(3), share, drift).collect()}
    hits = 0
    for k, text in enumerate(given):
        words = words_of(text)
        assert found[k].n_words == len(words)
        assert [tuple(b) for b in found[k].bases] == plain_bases(words)
        expected = plain_templates(words, share, drift)
        assert [tuple(t) for t in found[k].templates] == expected, text
        hits += len(expected)
    assert hits > 40


def test_rarity_changes_nothing_but_the_work():
    given = [t.encode() for t in texts(40, 5) if t]
    words = L.licence_words(L.TEMPLATES, L.PHRASES)
    some, others = (L.Index(L.TEMPLATES, L.PHRASES, {w: rank(w) for w in words}, 0.8, 2) for rank in (len, lambda w: -ord(w[0])))
    assert some.postings != others.postings
    for text in given:
        assert some.found(some.read(text)) == others.found(others.read(text))


def test_words_are_counted_over_all_documents(spark):
    frame = spark.createDataFrame([("MIT mit license",), ("a license",), (None,)] * 5, "text string").repartition(4)
    assert L.document_counts(frame, ["mit", "license", "bsd"]) == {"mit": 5, "license": 10}


def test_mandatory_phrases(spark):
    """All words but the one that names the version: no label of that version."""
    frame = spark.createDataFrame(
        [(1, "Licensed under the GNU General Public License, version 3."), (2, "Licensed under the GNU General Public License, version 4.")],
        "doc_id int, text string",
    )
    found = {r.doc_id: [t.label for t in r.templates] for r in L.scan(frame, 0.8, 2).collect()}
    assert found == {1: ["gpl-3.0"], 2: []}


def test_odd_rows(spark):
    rows = [(None, "mit license"), (None, "mit license"), (1, None), (1, "released under the mit license"), (1, "released under the mit license")]
    found = L.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), 0.8, 2).collect()
    assert sorted(len(r.templates) for r in found) == [0, 0, 0, 1, 1]
    assert L.scan(spark.createDataFrame([], "doc_id bigint, text string"), 0.8, 2).collect() == []


def test_long_repetitive_text(spark):
    text = "licensed under the mit license general public license version " * 60_000
    found = L.scan(spark.createDataFrame([(1, text)], "doc_id int, text string"), 0.8, 2).first()
    assert found.n_words == 540_000 and len(found.bases) == 60_000


def test_query(spark, sf_dir):
    rows = {r.doc_id: r for r in op13_license_scan(spark, sf_dir).collect()}
    texts_ = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts_)
    for doc_id, text in texts_:
        base, row = plain_bases(words_of(text)), rows[doc_id]
        starts = [k for k, _ in base]
        assert (row.n_base, row.first_word, row.last_word) == (len(base), min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in base}))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1
