from pyspark.sql import functions as F

from postingloom.llm import warc_audit

SCHEMA = "file bigint, offset bigint, length bigint, digest string, kind string"


def slow(one, other):
    a, b = ({r[:2]: r[2:4] for r in t} for t in (one, other))
    kind = {k: "missing" if k not in b else "added" if k not in a else "altered" for k in a.keys() | b.keys() if a.get(k) != b.get(k)}
    return sorted((*k, (a.get(k) or b.get(k))[0], v) for k, v in kind.items())


def audited(spark, one, other):
    frames = [spark.createDataFrame(t, SCHEMA) for t in (one, other)]
    return sorted(map(tuple, warc_audit.audit(*frames).collect()))


def test_damage_is_located(spark):
    one = [(f, 70_000 * k + 300 * j, 300, f"d{f}.{k}.{j}", "x") for f in range(3) for k in range(40) for j in range(5)]
    other = list(one)
    other[7] = (*other[7][:3], "rot", "x")
    other[250] = (*other[250][:2], 299, *other[250][3:])
    del other[100], other[-1]
    other += [(2, 10**9, 300, "new", "x"), (9, 0, 300, "file", "x")]
    assert audited(spark, one, other) == slow(one, other)
    assert audited(spark, one, one) == []


def test_only_unequal_ranges_are_read(spark):
    one = [(0, 70_000 * k, 300, f"d{k}", "x") for k in range(300)]
    other = [*one[:10], (*one[10][:3], "rot", "x"), *one[11:]]
    trees = [warc_audit.tree(spark.createDataFrame(t, SCHEMA), 4, "t") for t in (one, other)]
    unequal = [warc_audit._unequal(a, b, ["file", "place"]).count() for a, b in zip(*trees, strict=True)]
    assert unequal == [1, 1, 1, 1]


def test_empty_and_missing(spark):
    rows = [(0, 0, 300, None, "x"), (None, 0, 300, "a", "x"), (0, None, 300, "b", "x"), (1, 5, 300, "c", "x")]
    assert audited(spark, [], []) == []
    assert audited(spark, rows, rows) == []
    assert audited(spark, rows, []) == [(0, 0, 300, "missing"), (1, 5, 300, "missing")]
    assert audited(spark, [], rows) == [(0, 0, 300, "added"), (1, 5, 300, "added")]


def test_records_lie_side_by_side(spark):
    rows = [(1, "http://a", "<p>é</p>"), (2, None, None), (None, "http://b", ""), (None, "http://b", ""), (3, "http://c", "x" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = sorted(warc_audit.records(pages, 1, "2026-01-01T00:00:00Z").collect(), key=lambda r: r.offset)
    at = 0
    for r in found:
        assert r.offset == at
        at += r.length
    made = pages.where("page_id = 1").select(
        warc_audit.record_bytes(F.col("url"), "2026-01-01T00:00:00Z", F.col("html")).alias("b")
    ).first().b
    assert bytes(made).endswith("Content-Length: 9\r\n\r\n<p>é</p>\r\n\r\n".encode()) and len(made) in {r.length for r in found}
    assert warc_audit.records(pages.limit(0), 1, "x").count() == 0
