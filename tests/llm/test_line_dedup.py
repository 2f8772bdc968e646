import hashlib

import duckdb
import pytest

from postingloom.llm.line_dedup import without_repeats
from postingloom.llm.oracles import oracle_sql

P = "first line here\nsecond line here\nthird line here"


def digest(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def texts(frame):
    return sorted(((r.doc_id, r.text, r.n_removed) for r in without_repeats(frame).collect()), key=str)


def test_later_passage_goes(documents):
    frame = documents((2, f"own one\n{P}\nown two", "a"), (1, f"{P}\n\nmore", "a"), (3, P, "b"))
    assert texts(frame) == [(1, f"{P}\n\nmore", 0), (2, "own one\nown two", 3), (3, "", 3)]


def test_windows_merge_and_blank_lines_do_not_count(documents):
    four = P + "\nfourth line here"
    frame = documents((1, four, "a"), (2, "x\n" + four.replace("\n", "\n \t\n") + "  \ny", "a"))
    assert texts(frame)[1] == (2, "x\n \t\n \t\n \t\ny", 4)


def test_two_lines_are_no_passage(documents):
    two = "first line here\nsecond line here"
    assert texts(documents((1, two, "a"), (2, two, "a"))) == [(1, two, 0), (2, two, 0)]


def test_within_one_document(documents):
    frame = documents((1, f"{P}\nmiddle\n{P}", "a"), (2, "a\na\na\na\na", "a"))
    assert texts(frame) == [(1, f"{P}\nmiddle", 3), (2, "a\na\na", 2)]


def test_ids_missing_or_shared(documents):
    frame = documents((None, f"n\n{P}", "a"), (5, P, "a"), (5, f"{P}\nz", "a"), (5, P, "a"), (None, None, "a"), (7, "", None))
    first = min(P, f"{P}\nz", key=digest)
    of_five = [(5, P, 0)] * 2 + [(5, "z", 3)] if first == P else [(5, "", 3)] * 2 + [(5, f"{P}\nz", 0)]
    assert texts(frame) == sorted([(None, "n", 3), *of_five, (None, None, 0), (7, "", 0)], key=str)


def test_first_of_texts_without_an_id(documents):
    rows = [f"own {k}\n{P}" for k in range(5)]
    first = min(rows, key=digest)
    found = texts(documents(*((None, text, "a") for text in rows)))
    assert found == sorted(((None, text, 0) if text == first else (None, text[:5], 3) for text in rows), key=str)


def test_ids_that_are_no_numbers(spark):
    rows = [("a-1", f"x\n{P}"), ("b-2", f"y\n{P}"), ("b-2", f"y\n{P}"), (None, f"z\n{P}")]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    first = min(("a-1", "b-2"), key=digest)
    assert texts(frame) == sorted(((i, text, 0) if i == first else (i, text[:1], 3) for i, text in rows), key=str)


def test_columns_named_like_helpers(spark):
    names = ["_owner", "_of", "_covered", "__owner", "owner", "n_removed", "key_id"]
    frame = spark.createDataFrame([(1, f"x\n{P}", *names), (2, f"y\n{P}", *names)], ["doc_id", "text", *names])
    out = without_repeats(frame)
    assert out.columns == frame.columns
    kept = [name for name in names if name != "n_removed"]
    assert [tuple(r[name] for name in kept) for r in out.collect()] == [tuple(kept)] * 2
    assert texts(frame) == [(1, f"x\n{P}", 0), (2, "y", 3)]


def test_the_sql_agrees_on_odd_ids(documents, tmp_path):
    rows = [(k % 7 or None, f"{'ab'[k % 2]}\n{P}\nend {k % 5}\n{P if k % 3 else 'x'}", "a") for k in range(40)]
    frame = documents(*rows, (3, None, None), (None, "", "a"))
    frame.write.parquet(str(tmp_path / "documents"))
    duck = duckdb.sql(oracle_sql()["op2_line_dedup"].replace("FROM documents", f"FROM '{tmp_path}/documents/*.parquet'"))
    assert sorted(map(str, duck.fetchall())) == sorted(str(tuple(r)) for r in without_repeats(frame).select("doc_id", "text", "n_removed").collect())


def test_long_text_and_clashing_columns(spark):
    long = "\n".join(f"line {k} of a long text" for k in range(20_000))
    frame = spark.createDataFrame([(1, long, 9, "h"), (2, long + "\nend", 9, "h")], "doc_id bigint, text string, n_removed int, h string")
    rows = {r.doc_id: r for r in without_repeats(frame).collect()}
    assert rows[1].text == long and rows[2].text == "end" and rows[2].n_removed == 20_000 and rows[2].h == "h"


def test_no_rows(documents):
    assert texts(documents()) == []


@pytest.mark.parametrize("n", [40])
def test_passage_in_many_documents(documents, n):
    found = texts(documents(*((k, f"own {k}\n{P}", "a") for k in range(n))))
    assert sum(removed for _, _, removed in found) == 3 * (n - 1)
