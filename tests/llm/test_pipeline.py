"""The pipeline, stage by stage and as a whole, against plain Python."""

import hashlib
import re
from collections import Counter

import pytest
from test_bpe import ORACLE
from test_quality_rules import slow_base
from test_simhash import slow_components, slow_fingerprint
from test_source_mix import slow_targets

import corpus_pipeline
from postingloom.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def normal(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in " ".join(WORD.findall(line)))


def slow_quality(rows):
    hosts, seen = {}, {}
    for _, text, _, source, _ in rows:
        hosts.setdefault(source, set()).add(text or "")
        for line in (text or "").split("\n"):
            if normal(line):
                seen.setdefault((source, normal(line)), set()).add(text)
    gone = {k for k, texts in seen.items() if len(texts) > 10 and 100 * len(texts) > 5 * len(hosts[k[0]])}
    out = []
    for doc_id, text, lang, source, n_chars in rows:
        n_words, *_, failed = slow_base(text)
        lines = (text or "").split("\n")
        left = [line for line in lines if (source, normal(line)) not in gone]
        n_left = sum(len(WORD.findall(line)) for line in left)
        if not failed and n_left >= 10 and 100 * n_left >= 30 * n_words:
            new = text if len(left) == len(lines) else "\n".join(left)
            out.append((doc_id, new, lang, source, len(new)))
    return out


def slow_lines(rows):
    places = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        at = [i for i, line in enumerate(lines) if WORD.search(line)]
        bare = [lines[i].strip(" \t\n\x0b\x0c\r") for i in at]
        places.append([(tuple(bare[k : k + 3]), at[k : k + 3], k) for k in range(len(at) - 2)])
    first = {}
    for (doc_id, *_), windows in sorted(zip(rows, places, strict=True), key=lambda x: x[0][0]):
        for w, _, k in windows:
            first.setdefault(w, (doc_id, k))
    out = []
    for (doc_id, text, lang, source, n_chars), windows in zip(rows, places, strict=True):
        gone = set()
        for w, at, k in windows:
            if first[w][0] != doc_id:
                gone.update(at)
            elif first[w][1] != k:
                gone.update(i for n, i in enumerate(at) if k + n >= first[w][1] + 3)
        if gone:
            text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
        out.append((doc_id, text, lang, source, None if text is None else len(text)))
    return out


def slow_near(rows):
    kept = {i for i, c in slow_components([(r[0], slow_fingerprint(r[1])) for r in rows], 2) if i == c}
    return [r for r in rows if r[0] in kept]


def slow_mix(rows):
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    out = []
    for source, target in slow_targets(sizes).items():
        def key(row):
            size = len(WORD.findall(row[1] or ""))
            name = str(row[0]).encode()
            return len(str(size)) * 100 + int(str(size)[:2]), hashlib.md5(name).hexdigest()[:2], size, row[0]

        own = sorted((r for r in rows if r[3] == source), key=key)
        rate = target / sizes[source] if sizes[source] else 0.0
        offset = int(hashlib.md5(("mix" + (source or "")).encode()).hexdigest()[:8], 16) / 2**32
        rest = rate - int(rate)
        for k, row in enumerate(own, 1):
            out += [row] * (int(rate) + int(offset + k * rest) - int(offset + (k - 1) * rest))
    return out


SLOW = [slow_quality, slow_lines, slow_near, slow_mix]


@pytest.fixture(scope="module")
def inputs(sf_dir, spark):
    """Rows before each stage, from the plain versions."""
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select(*COLUMNS).collect()]
    stages = [rows]
    for slow in SLOW:
        stages.append(slow(stages[-1]))
    return stages


@pytest.mark.parametrize("k", range(len(SLOW)))
def test_stage(spark, sf_dir, inputs, k):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    found = corpus_pipeline.STAGES[k][1](spark, spark.createDataFrame(inputs[k], schema), sf_dir)
    assert found.columns == COLUMNS
    assert Counter(map(tuple, found.collect())) == Counter(inputs[k + 1])
    assert 0 < len(inputs[k + 1])


def test_run(spark, sf_dir, inputs):
    found = corpus_pipeline.run(spark, sf_dir).collect()
    expected = Counter((r[0], tuple(ORACLE.encode_ordinary(r[1] or ""))) for r in inputs[-1])
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in found) == expected
    assert all(r.decodes and r.n_tokens == len(r.token_ids) for r in found)


def test_odd_rows(spark, sf_dir):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, component_id string"
    long = "\n".join(f"Line number {k} tells of thing {k * 7} and of place {k * 13}." for k in range(2_000))
    rows = [(1, None, None, None, None, "a", "b"), (None, "", None, None, 0, "a", "b"), (2, long, "en", None, len(long), None, None),
            (None, "Ten words or more are what a document has to have here now", None, "s", 58, None, None)]
    rows += [(3, long.replace("Line", "Row"), "en", "s", len(long), None, None)] * 2
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), stage(spark, docs, sf_dir).schema)
        if name != "byte-level bpe":
            assert docs.columns == [c.split()[0] for c in schema.split(", ")], name
    assert docs.count() > 0 and docs.where("not decodes").count() == 0


def test_no_rows(spark, sf_dir):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
