import pytest

from postingloom.llm import source_mix
from postingloom.llm.parameters import MIX


def slow_targets(sizes, weights=(3, 1, 2), percent=150, most=2):
    """Share by weight, stop at the limits, share the excess again, until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()) * percent / 100, set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / free for s in order}
        above = {s for s in order if s not in capped and target[s] > most * sizes[s]}
        if not above:
            return target
        capped |= above


def rows_of(sizes):
    return [(1000 * k + j, "w " * (1 + j % 7), s) for k, (s, n) in enumerate(sizes) for j in range(n)]


@pytest.mark.parametrize(
    "sizes", [[("a", 300), ("b", 20), ("c", 50), (None, 10)], [("a", 5), ("B", 500), ("ä", 80), ("z", 1)], [("one", 200)]]
)
def test_targets_and_copies(documents, sizes):
    rows = rows_of(sizes)
    found = source_mix.mix(documents(*rows), **MIX).collect()
    assert len(found) == len(rows)
    words = {}
    for _, text, s in rows:
        words[s] = words.get(s, 0) + len(text.split())
    expected = slow_targets(words)
    for s, target in expected.items():
        own = [r for r in found if r.source == s]
        assert all(r.target == pytest.approx(target) and r.source_size == words[s] for r in own)
        assert all(0 <= r.copies <= 2 for r in own)
        assert abs(sum(r.copies * r.size for r in own) - target) <= 2 * 7
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, source_mix.mix(documents(*rows[::-1]), **MIX).collect()), key=str)


def test_taken(documents):
    mixed = source_mix.mix(documents(*rows_of([("a", 60), ("b", 30)])), **MIX)
    copies = {r.doc_id: r.copies for r in mixed.collect() if r.copies}
    out = source_mix.taken(mixed).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in out} == copies


def test_odd_rows(spark):
    rows = [(None, None, None, "x", 1)] * 3 + [(1, "", "a", "x", 1)] * 2 + [(1, "w " * 20_000, "a", "x", 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, target string, copies int")
    found = source_mix.mix(frame, **MIX).collect()
    assert len(found) == 6
    assert {(r.source, r.source_size, r.target) for r in found} == {(None, 0, 0.0), ("a", 20_000, 30_000.0)} or {
        (r.source, r.source_size) for r in found
    } == {(None, 0), ("a", 20_000)}
    empty = spark.createDataFrame([(1, None, "a"), (2, None, "b")], "doc_id bigint, text string, source string")
    assert {(r.source_size, r.copies * r.size) for r in source_mix.mix(empty, **MIX).collect()} == {(0, 0)}
    assert source_mix.mix(frame.limit(0), **MIX).count() == 0


def test_columns_named_like_helpers(spark):
    names = ["_id", "_text", "_source", "_class", "_part", "_group", "_place", "_target", "_copy", "_num_n", "place"]
    frame = spark.createDataFrame([(k, "w " * (1 + k % 5), "ab"[k % 2], *names) for k in range(40)], ["doc_id", "text", "source", *names])
    mixed = source_mix.mix(frame, **MIX)
    assert sorted(mixed.columns) == sorted([*frame.columns, "size", "source_size", "target", "copies"])
    plain = source_mix.mix(frame.select("doc_id", "text", "source"), **MIX)
    assert sorted((r.doc_id, r.copies) for r in mixed.collect()) == sorted((r.doc_id, r.copies) for r in plain.collect())
    assert {tuple(r[name] for name in names) for r in source_mix.taken(mixed).collect()} == {tuple(names)}


def test_ids_that_are_no_numbers(spark):
    frame = spark.createDataFrame([(f"a-{k}", "w " * (1 + k % 5), "ab"[k % 2]) for k in range(40)], "doc_id string, text string, source string")
    assert source_mix.mix(frame, **MIX).select("doc_id").distinct().count() == 40
