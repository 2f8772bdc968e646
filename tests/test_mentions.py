"""Names of a table in texts, against plain substring tests."""

import random

import pytest
from compare import plan_of

from postingloom.operators import mentions


def rows_of(found):
    return sorted(map(tuple, found.collect()), key=repr)


def expected(texts, names):
    wanted = {n for n in names if n}
    return sorted({(key, n) for key, text in texts if text is not None for n in wanted if n in text}, key=repr)


def frames(spark, texts, names):
    return spark.createDataFrame(texts, "k string, t string"), spark.createDataFrame([(n,) for n in names], "name string")


@pytest.fixture(params=["sent", "shuffled"])
def way(request, monkeypatch):
    """Short lists go to all executors, long ones are shuffled; both give the same rows."""
    if request.param == "shuffled":
        monkeypatch.setattr(mentions, "SENT_NAMES", 2)
    return request.param


def test_ten_thousand_names(spark, way):
    rng = random.Random(1)
    names = sorted({"".join(rng.choices("abcdeé ", k=rng.randrange(3, 12))) for _ in range(11_000)})[:10_000]
    texts = [(f"k{rng.randrange(60)}", "".join(rng.choices("abcdeé ", k=rng.randrange(300)))) for _ in range(120)]
    frame, table = frames(spark, texts, names)
    found = mentions.mentioned(frame, ["k"], "t", table)
    assert rows_of(found) == expected(texts, names)
    plan = plan_of(found)
    assert not any(mark in plan for mark in ("NestedLoop", "Cartesian", "collect_set", "lambda"))
    if way == "sent":
        assert "BroadcastHashJoin" in plan


def test_odd_names_and_texts(spark, way):
    names = ["sql", "mysql", "c", "go", "r", "日本", "日", "é", "", None, "power bi", "sql", "aaa", "aaaaaa"]
    texts = [
        ("1", "mysql"), ("2", "sq"), ("3", ""), ("4", None), ("5", "日本語 café"), (None, "go power bi"), (None, "aaaaa"), ("6", "aaaaaaa"),
        ("7", "c"), ("7", "c"), ("8", "sql at the end sql"), ("9", "\x00sql\x00"),
    ]
    frame, table = frames(spark, texts, names)
    assert rows_of(mentions.mentioned(frame, ["k"], "t", table)) == expected(texts, names)


def test_nothing_to_look_for(spark):
    frame, table = frames(spark, [("1", "text")], ["", None])
    assert rows_of(mentions.mentioned(frame, ["k"], "t", table)) == []
    frame, table = frames(spark, [], ["sql"])
    assert rows_of(mentions.mentioned(frame, ["k"], "t", table)) == []


def test_each_name_under_its_rarest_trigram(spark):
    _, table = frames(spark, [], ["sql", "mysql", "nosql", "postgresql"])
    found = {r.name: (bytes(r.gram).decode(), r.at) for r in mentions.name_index(table, "name").collect()}
    assert found["sql"] == ("sql", 0) and found["mysql"][0] in ("mys", "ysq")
    assert all(name[at : at + 3] == gram for name, (gram, at) in found.items())


def test_a_text_of_one_letter_repeated(spark):
    frame, table = frames(spark, [("1", "a" * 200_000 + "b")], ["ab", "aaab", "ba"])
    assert rows_of(mentions.mentioned(frame, ["k"], "t", table)) == [("1", "aaab"), ("1", "ab")]
