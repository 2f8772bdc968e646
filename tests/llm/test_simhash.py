import random

import pytest
import xxhash

from postingloom.llm import simhash
from postingloom.llm.components import connected_components
from postingloom.llm.queries import op5_simhash


def slow_fingerprint(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                found.append(word)
            word = ""
        else:
            word += c
    if not found:
        return 0
    pieces = [" ".join(found[k : k + shingle]) for k in range(max(1, len(found) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(prints, distance):
    """doc ids by smallest reachable one, from (doc_id, fingerprint)."""
    values = sorted({p for _, p in prints})
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for k, a in enumerate(values):
        for b in values[k + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for doc_id, p in prints:
        if doc_id is not None:
            least[find(p)] = min(least.get(find(p), doc_id), doc_id)
    return [(doc_id, least.get(find(p))) for doc_id, p in prints]


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(k, k + 1) for k in range(100, 140)] + [(7, 7)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    root = {n: n for pair in links for n in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    alone = {n for n in root if all(a == b for a, b in links if n in (a, b))}
    assert found == {n: r for n, r in root.items() if n not in alone or n in found}


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
@pytest.mark.parametrize("short_list", [0, 2, 64])
def test_links_reach_what_pairs_reach(spark, monkeypatch, distance, short_list):
    if distance == 3 and short_list != 0:
        pytest.skip("long lists are the case of interest")
    monkeypatch.setattr(simhash, "SHORT_LIST", short_list)
    rng = random.Random(distance)
    values = [rng.getrandbits(64) for _ in range(12)]
    for _ in range(60):
        value = rng.choice(values)
        for _ in range(rng.randrange(4)):
            value ^= 1 << rng.randrange(64)
        values.append(value)
    values += [0, 1, 3, (1 << 64) - 1]
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint")
    pairs = {(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(frame, distance).collect()}
    assert all((a ^ b).bit_count() <= distance for a, b in pairs)
    root = {v: v for v in values}
    for _ in range(30):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    expected = dict.fromkeys(values)
    groups = slow_components([(v, v) for v in set(values)], distance)
    assert {v: root[v] for v in expected} == dict(groups)


TEXTS = [
    "The quick brown fox jumps over the lazy dog", "the QUICK brown fox jumps over the lazy dog", "", None, " \t\n", "one",
    "One", "two words", "É é", "a b c d " * 2_000, "Kelvin K sign", "x y z w",
]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode(), 3) % (1 << 64) == slow_fingerprint(text)


def test_odd_rows(spark):
    rows = [(k, t, 1) for k, t in enumerate(TEXTS)] + [(None, "one", 2), (None, "nameless text here now", 2), (0, TEXTS[0], 3)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, fp int")
    found = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(frame, 3, 2).collect()), key=str)
    assert found == sorted(slow_components([(i, slow_fingerprint(t)) for i, t, _ in rows], 2), key=str)


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(frame, 3, 2).count() == 0
    assert simhash.one_of_each(frame, 3, 2).count() == 0


def test_one_of_each(spark):
    rows = [(3, "same text here"), (1, "same text here"), (1, "same text here"), (2, ""), (5, None), (None, "no id at all"),
            (None, "no id at all"), (None, "same text here"), (9, "quite another one")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 2).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(
        [(1, "same text here"), (2, ""), (None, "no id at all"), (9, "quite another one")], key=str
    )


def test_one_of_each_with_columns_named_like_helpers(spark):
    names = ["_root", "_fp", "_doc_id", "_place", "root", "fp", "text_hash", "component_id"]
    frame = spark.createDataFrame([(k, "one text that has a copy" if k < 3 else f"own {k} x", *names) for k in range(5)], ["doc_id", "text", *names])
    kept = simhash.one_of_each(frame, 3, 2)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4]


def test_one_of_each_where_ids_collide(spark):
    other, shared, near = "another text that is long enough to be far", "a text that two rows have in common", "x y z w"
    rows = [(3, shared), (5, shared), (5, other), (5, None), (3, near), (8, None), (8, ""), (None, "no id at all")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 2).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(
        [(3, shared), (5, other), (5, None), (3, near), (None, "no id at all")], key=str
    )
    kept = simhash.one_of_each(spark.createDataFrame([(8, None), (8, ""), (9, None)], "doc_id bigint, text string"), 3, 2)
    assert list(map(tuple, kept.collect())) == [(8, "")]


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in op5_simhash(spark, sf_dir).collect()}
    components = dict(slow_components(prints, 2))
    assert found == {i: (f"{p:016x}", components[i]) for i, p in prints}
