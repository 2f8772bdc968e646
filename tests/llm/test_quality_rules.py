import random
import re

import pytest

from postingloom.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_base(text):
    t = text or ""
    words = WORD.findall(t)
    grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    covered = {k + n for k, g in enumerate(grams) if grams.count(g) > 1 for n in range(5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(covered), failed


TEXTS = [
    None, "", " \n\t", "one two", "a b c d e " * 5, "a b c d e f g h i j k l m", "x # * $ % & | < > y " * 2,
    "same line\nsame line\n\nsame line \nother", "a a a a a a a a a a a a", "é ö ü x " * 4, "w" * 50_000,
]


def base(frame):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return {r.doc_id: tuple(r[n] for n in names) for r in quality_rules.base_statistics(frame).collect()}


def test_base(documents):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(40)]
    found = base(documents(*((k, t, "s") for k, t in enumerate(texts))))
    assert found == {k: slow_base(t) for k, t in enumerate(texts)}


def own_text(k, n=30):
    return " ".join(f"w{k}x{j}" for j in range(n))


def test_frequent_lines_and_depleted_documents(documents):
    note = "We use cookies on this  site and on others to make it work for all of you"
    rows = [(k, f"{note.upper() if k % 2 else note}\n{own_text(k)}", "host") for k in range(20)]
    rows += [(100 + k, f"{own_text(100 + k)}", "host") for k in range(20)]
    rows += [(200, note + "\n" + own_text(200, 4), "host"), (201, note + "\n" + own_text(201), "other")]
    frame = documents(*rows)
    found = {r.doc_id: r for r in quality_rules.judged(frame).collect()}
    assert all(found[k].kept and found[k].n_kept_words == 30 for k in range(20))
    assert not found[200].kept and not found[200].base_failed
    assert found[201].kept and found[201].n_kept_words == 30 + len(note.split())
    kept = {r.doc_id: r.text for r in quality_rules.kept_documents(frame).collect()}
    assert 200 not in kept and kept[3] == own_text(3) and kept[201].startswith(note)


def test_copies_count_as_one_document(documents):
    text = "a line that many copies of one text have and nothing else at all here\n" + own_text(1)
    frame = documents(*((k, text, "host") for k in range(40)))
    assert all(r.kept and r.n_kept_words == r.n_words for r in quality_rules.judged(frame).collect())


def test_odd_rows(spark):
    schema = "doc_id bigint, text string, source string, kept string, words int, _x int"
    rows = [(None, own_text(1), None, "k", 1, 1)] * 3 + [(4, None, None, None, None, None), (4, own_text(2), "s", "k", 1, 1)]
    frame = spark.createDataFrame(rows, schema)
    judged = quality_rules.judged(frame).collect()
    assert len(judged) == 5 and sum(r.kept for r in judged) == 4
    assert {r.words for r in judged} == {1, None}
    assert quality_rules.kept_documents(frame).count() == 4
    assert quality_rules.judged(frame.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["a b c d e f g h i j " * 3_000])
def test_long_repetitive_text(documents, text):
    assert base(documents((1, text, "s")))[1][4] == 30_000


def test_columns_named_like_helpers_and_ids_that_are_no_numbers(spark):
    names = ["_statistics", "_own_id", "_gone_id", "_removed", "_of_id", "_n_removed_words", "key_id", "line"]
    rows = [(f"d-{k}", "shared line of many\n" + " ".join(f"w{k}x{n}" for n in range(30)), "h", *names) for k in range(20)]
    frame = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    kept = quality_rules.kept_documents(frame)
    assert kept.columns == frame.columns
    found = kept.collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows) and not any("shared" in r.text for r in found)
    assert {tuple(r[name] for name in names) for r in found} == {tuple(names)}
    assert quality_rules.judged(frame).columns[: len(frame.columns)] == frame.columns
