import numpy as np
import pytest

from postingloom.llm import embedding_dedup
from postingloom.llm.parameters import EMBEDDING
from postingloom.llm.queries import op7_embeddings

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def slow(rows, cosine=0.95):
    """(vec_id, n_links, component_id) with every pair compared."""
    def usable(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [k for k, row in enumerate(rows) if usable(row[1])]
    links, root = [0] * len(rows), list(range(len(rows)))
    if good:
        x = np.array([rows[k][1] for k in good], dtype=np.float32).astype(np.float64)
        x /= np.linalg.norm(x, axis=1)[:, None]
        near = x @ x.T >= cosine
        np.fill_diagonal(near, False)
        label = np.arange(len(good))
        for _ in range(len(good)):
            new = np.minimum(label, np.where(near, label[None, :], len(good)).min(axis=1))
            if (new == label).all():
                break
            label = new
        for i, k in enumerate(good):
            links[k], root[k] = int(near[i].sum()), good[label[i]]
    names = {}
    for k, row in enumerate(rows):
        if row[0] is not None:
            names[root[k]] = min(names.get(root[k], row[0]), row[0])
    return sorted(((row[0], links[k], names.get(root[k])) for k, row in enumerate(rows)), key=str)


def found(frame, **options):
    rows = embedding_dedup.near_duplicates(frame, **(EMBEDDING | options)).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=str)


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 16))
    group = base[0] + 0.02 * rng.normal(size=(90, 16))
    copies = np.repeat(base[1:2], 40, axis=0)
    vectors = np.concatenate([base, group, copies, base[2:40] + 0.03 * rng.normal(size=(38, 16))]).astype(np.float32)
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(vectors)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == slow(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, nan], 0), (5, [1.0, inf], 0), (6, [1.0, None], 0),
            (7, [1.0, 0.0], 0), (8, [2.0, 0.0], 0), (9, [-1.0, 0.0], 0), (None, [1.0, 0.0], 0), (7, [1.0, 0.0], 0), (3, [0.0, 0.0], 0)]
    rows_found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), **EMBEDDING).collect()
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in rows_found), key=str)
    assert got == slow(rows)


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(6)
    rows, expected = [], []
    for width, n in ((16, 60), (24, 40), (1, 3), (2, 9)):
        base = rng.normal(size=(n, width))
        vectors = np.concatenate([base, base[: n // 2] + 0.01 * rng.normal(size=(n // 2, width)), base[:2]]).astype(np.float32)
        own = [(len(rows) + k, [float(x) for x in v], 0) for k, v in enumerate(vectors)]
        rows += own
        expected += slow(own)
    rng.shuffle(rows)
    got = found(spark.createDataFrame([(int(k), v, 0) for k, v, _ in rows], SCHEMA))
    assert got == sorted(expected, key=str)


def test_no_rows(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, None, 0)], SCHEMA)) == [(1, 0, 1)]


def test_recall_at_the_threshold(spark):
    """Pairs of exactly the least cosine, the hardest to find, are found at 0.9 or more."""
    rng = np.random.default_rng(9)
    a = rng.normal(size=(1_000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    b = 0.951 * a + np.sqrt(1 - 0.951**2) * side
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(np.concatenate([a, b]))]
    n_links = sum(n for _, n, _ in found(spark.createDataFrame(rows, SCHEMA)))
    assert n_links >= 0.9 * sum(n for _, n, _ in slow(rows))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in op7_embeddings(spark, folder).collect()), key=str)
    assert got == slow(rows)
