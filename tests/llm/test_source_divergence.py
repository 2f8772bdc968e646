import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from postingloom.llm import source_divergence as S

SCHEMA = "lang string, source string, text string, row int, col int, term string, n string, value int, part int"


def plain(rows, least_docs, top):
    rows = [tuple(v or "" for v in row[:3]) for row in rows]
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(upper)) for _, _, text in rows]
    docs, counts = Counter(), defaultdict(Counter)
    for (lang, source, _), found in zip(rows, terms, strict=True):
        docs.update((lang, term) for term in set(found))
        counts[lang, source].update(found)
    result = []
    for lang, source in counts:
        kept = [term for of, term in docs if of == lang and docs[of, term] >= least_docs]
        others = [s for of, s in counts if of == lang and s != source]

        def shares(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        own, whole = shares(counts[lang, source]), shares(sum((counts[k] for k in counts if k[0] == lang), Counter()))
        pairs = [(sum(f(own[t], other[t]) for t in kept), s) for s in others for other in [shares(counts[lang, s])]]
        ahead = [(f(own[t], whole[t]), t) for t in kept if counts[lang, source][t] and own[t] > whole[t]]
        for part, found in (("pair", pairs), ("term", ahead)):
            ranked = sorted(found, key=lambda v: (-v[0], v[1].encode()))[: None if part == "pair" else top]
            result += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(result)


def rows_of(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "a1b", "größe", "É", "x'y", "日本"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    made = []
    for _ in range(n):
        source = rng.choice(["hot", "hot", "hot", None, "", "é", *(f"s{k}" for k in range(12))])
        own = words[:7] if source in ("s1", "s2") else words[7:] if source in ("s3", "s4") else words
        text = rng.choice([None, "", " 12 ", *[" ".join(rng.choice(own) for _ in range(rng.randrange(40)))] * 6])
        made.append((rng.choice(["en", "en", None, "", "xx" if source == "s5" else "en"]), source, text, 1, 2, "t", "n", 3, 4))
    return made + made[:9]


@pytest.mark.parametrize("k, rows, cols", [(2, 1, 1), (2, 2, 4), (4, 4, 256)])
def test_against_plain_sums(spark, monkeypatch, k, rows, cols):
    monkeypatch.setattr(S, "K", k)
    monkeypatch.setattr(S, "LEAF_ROWS", rows)
    monkeypatch.setattr(S, "LEAF_COLS", cols)
    given = rows_of(500, k + rows)
    found = S.audit(spark.createDataFrame(given, SCHEMA).repartition(3), 4, 5)
    assert sorted(map(tuple, found.collect())) == plain(given, 4, 5)


def test_zero_quadrants_are_priced_without_their_cells(spark, monkeypatch):
    """Sources without a term in common: the walk stops at pairs of quadrants that neither has anything in."""
    for name, value in (("K", 2), ("LEAF_ROWS", 1), ("LEAF_COLS", 4)):
        monkeypatch.setattr(S, name, value)
    rows = [("en", f"s{k}", " ".join(f"{chr(97 + k)}{chr(97 + i)}" for i in range(16))) for k in range(8) for _ in range(10)]
    counts = S.term_counts(spark.createDataFrame(rows, "lang string, source string, text string"))
    groups, _, cells = S.matrix(counts, 10)
    levels = S.n_levels(groups)
    zeros, leaves = S.walk(groups, S.quadrants(cells, levels), levels)
    compared = sum(r.width for r in leaves.where("a < b").collect())
    priced = sum(r.width * r.rows**2 for r in zeros.where("a < b").collect())
    assert priced > compared > 0
    found = S.audit(spark.createDataFrame(rows, "lang string, source string, text string"), 10, 3)
    assert sorted(map(tuple, found.collect())) == plain(rows, 10, 3)


def test_counts_in_bounded_pieces(spark, monkeypatch):
    monkeypatch.setattr(S, "HELD", 20)
    monkeypatch.setattr(S, "CHUNK", 3)
    given = rows_of(200, 9)
    found = S.audit(spark.createDataFrame(given, SCHEMA), 3, 4)
    assert sorted(map(tuple, found.collect())) == plain(given, 3, 4)


def test_no_rows_and_no_kept_terms(spark):
    assert S.audit(spark.createDataFrame([], SCHEMA), 10, 10).collect() == []
    rows = [("en", "a", "one"), ("en", "b", None), ("fr", "a", "")]
    found = S.audit(spark.createDataFrame(rows, "lang string, source string, text string"), 10, 10)
    assert sorted(map(tuple, found.collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_long_text_and_large_counts(spark):
    rows = [("en", "a", "big " * 300_000 + "small"), ("en", "b", "small")] * 2
    found = S.audit(spark.createDataFrame(rows, "lang string, source string, text string"), 2, 10)
    assert sorted(map(tuple, found.collect())) == plain(rows, 2, 10)
    one = spark.range(1).selectExpr("9000000000000L n", "9000000000001L m", "5L v").select(S.share("n", "m", "v"), S.price("1000000001L", "1L"))
    assert tuple(one.first()) == (1 + 10**9 * 9000000000002 // 9000000000011, 10**18 // (10**9 + 2))


def test_leaf_sums_by_hand():
    a = (np.array([4]), np.array([3]), np.array([9]), np.array([1, 2]))
    b = (np.array([], int), np.array([], int), np.array([], int), np.array([5]))
    assert S.leaf_sums(a, b, 3).tolist() == [[(9 - 5) ** 2 // 14 + 2 * ((1 - 5) ** 2 // 6)], [3 * ((2 - 5) ** 2 // 7)]]
