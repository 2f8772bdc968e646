import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from postingloom.llm import merkle_manifest as M

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, owner int, place string, n int, digest int, `key` int"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """Root, and per leaf the (left, right) siblings from the leaf up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = place // 16 * 16
            paths[k].append((nodes[run:place], nodes[place + 1 : run + 16]))
            at[k] = place // 16
        nodes = [H(*nodes[k : k + 16]) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def plain(rows, shown_text):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        own = [(r, leaf(r[:5]), leaf((*r[:4], shown_text(r)))) for r in rows if r[1] == source]
        own.sort(key=lambda o: (o[0][0] is not None, o[0][0] or 0, o[1]))
        trees[source] = (own, *plain_tree([o[1] for o in own]))
    root, above = plain_tree([trees[s][1] for s in sources])
    result = []
    for source, more in zip(sources, above, strict=True):
        own, subroot, paths = trees[source]
        for (row, digest, shown), path in zip(own, paths, strict=True):
            steps = path + more
            folded = shown
            for left, right in steps:
                folded = H(*left, folded, *right)
            proof = H(*(d for left, right in steps for d in (*left, *right)))
            result.append((row[0], digest, subroot, root, proof, folded, folded == root))
    return sorted(result, key=repr)


def rows_of(n, seed):
    rng = random.Random(seed)
    made = []
    for k in range(n):
        source = rng.choice(["hot", "hot", "hot", "b", "é", "", None, f"s{rng.randrange(40)}"])
        doc_id = rng.choice([None, k, k, k, k, 7])
        text = rng.choice([None, "", "Abc", f"Text {k}", "Ü" * 3])
        made.append((doc_id, source, rng.choice([None, "en"]), rng.choice([None, k]), text, 1, "x", 2, 3, 4))
    return made + made[:5]


def spoiled(row):
    return row[4].lower() if row[4] and row[0] is not None and row[0] % 3 == 0 and row[4].isascii() else row[4]


def proofs(spark, rows, parts=3):
    held = F.when((F.col("doc_id") % 3 == 0) & ~F.col("text").rlike("[^\\x00-\\x7F]"), F.lower("text")).otherwise(F.col("text"))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return M.manifest(frame, FIELDS, "source", "doc_id", {"text": held}).proofs()


@pytest.mark.parametrize("height", [1, 2])
def test_against_plain_trees(spark, monkeypatch, height):
    """Blocks of 16 and 256 leaves, so that trees and the tree of sources take several stages of blocks."""
    monkeypatch.setattr(M, "BLOCK_HEIGHT", height)
    monkeypatch.setattr(M, "BLOCK", 16**height)
    rows = rows_of(700, height)
    assert sorted(map(tuple, proofs(spark, rows).collect()), key=repr) == plain(rows, spoiled)


@pytest.mark.parametrize("n", [1, 16, 17])
def test_small_trees(spark, n):
    rows = [(k, "a", None, None, f"T{k}", 1, "x", 2, 3, 4) for k in range(n)]
    assert sorted(map(tuple, proofs(spark, rows).collect()), key=repr) == plain(rows, spoiled)


def test_empty_table(spark):
    assert proofs(spark, []).collect() == []


@pytest.mark.parametrize("levels", [1, 2, 3, 4])
def test_layout(levels):
    """Every address once; a subtree of the lower half lies in one stretch, and so does the upper half."""
    places = M.addresses(levels)
    assert sorted(at for depth in places for at in depth) == list(range(M.n_nodes(levels)))
    upper = levels // 2
    for subtree in range(M.FAN**upper if upper else 0):
        own = [
            at
            for depth in range(upper, levels)
            for at in places[depth][subtree * M.FAN ** (depth - upper) : (subtree + 1) * M.FAN ** (depth - upper)]
        ]
        assert max(own) - min(own) + 1 == len(own) == M.n_nodes(levels - upper)
    if upper:
        assert max(at for depth in places[:upper] for at in depth) == M.n_nodes(upper) - 1


@pytest.mark.parametrize("n_leaves", [1, 2, 16, 17, 255, 300, 4096])
def test_blocks_give_back_their_nodes(n_leaves):
    leaves = [H(str(k)) for k in range(n_leaves)]
    for height in {M.height_of(n_leaves), M.BLOCK_HEIGHT}:
        root, nodes = M.build_block(leaves, height)
        levels = M.stored_levels(nodes, n_leaves, height)
        for slot in {0, n_leaves // 2, n_leaves - 1}:
            assert M.fold(leaves[slot], M.siblings(levels, slot)) == root


def test_a_lone_leaf_needs_little_room():
    _, nodes = M.build_block([H("x")], M.BLOCK_HEIGHT)
    assert len(nodes) < 64 * M.DIGEST
