import base64

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postingloom.llm import bpe
from postingloom.llm.parameters import RANK_FILE
from postingloom.llm.queries import op1_byte_bpe

PATH = public_tokenizers.path(RANK_FILE)
RANKS = bpe.read_ranks(PATH)
ORACLE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
LONG = ["a" * 30_000, " " * 5_000, "ab" * 9_000, "é" * 4_000, "1234567890" * 500, "!?" * 3_000]


def ids(text):
    return bpe.encode_batch(ENCODER, [text]).to_pylist()[0]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_as_the_library(text):
    assert ids(text) == ORACLE.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abehst ", max_size=60))
def test_as_the_library_where_merges_overlap(text):
    assert ids(text) == ORACLE.encode_ordinary(text)


@pytest.mark.parametrize("text", LONG)
def test_long_pre_tokens(text):
    assert ids(text) == ORACLE.encode_ordinary(text)


def test_merge_queue_is_empty_afterwards():
    queue = bpe.RankQueue(RANKS)
    for text in LONG[:3]:
        queue.merge(text.encode()[:2_000])
        assert not queue.buckets and not any(queue.words)


def test_frame(spark):
    texts = ["", None, "Hello world", "Ünïcode\n\n  x", *LONG]
    frame = spark.createDataFrame([(k, t, "own") for k, t in enumerate(texts)] * 2, "doc_id bigint, text string, token_ids string")
    vocabulary = bpe.Vocabulary(spark, PATH, public_tokenizers.PATTERN)
    rows = bpe.decode(bpe.encode(frame, vocabulary), vocabulary).collect()
    assert len(rows) == 2 * len(texts)
    for row in rows:
        text = texts[row.doc_id] or ""
        assert row.token_ids == ORACLE.encode_ordinary(text)
        assert bytes(row.decoded) == text.encode()


def test_batches_of_many_chunks():
    import pyarrow as pa

    texts = [["", "a b", "ünï " * 3, "x" * 50][k % 4] for k in range(2 * bpe.CHUNK + 7)]
    encoded = bpe._by_chunks(pa.array(texts), lambda chunk: bpe.encode_batch(ENCODER, chunk.to_pylist()))
    assert encoded.to_pylist() == [ORACLE.encode_ordinary(t) for t in texts]
    tokens = bpe._tokens({"ranks": RANKS})
    assert bpe._by_chunks(encoded, lambda chunk: bpe.decode_batch(tokens, chunk)).to_pylist() == [t.encode() for t in texts]
    assert len(bpe._by_chunks(encoded.slice(0, 0), lambda chunk: bpe.decode_batch(tokens, chunk))) == 0


def test_null_ids_and_foreign_ids(spark):
    vocabulary = bpe.Vocabulary(spark, PATH, public_tokenizers.PATTERN)
    frame = spark.createDataFrame([(None,), ([],), ([1, None],)], "token_ids array<int>")
    found = [bytes(r.decoded) for r in bpe.decode(frame, vocabulary).collect()]
    token = {rank: t for t, rank in RANKS.items()}[1]
    assert found == [b"", b"", token]
    foreign = spark.createDataFrame([([10**6],)], "token_ids array<int>")
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(foreign, vocabulary).collect()


def test_no_rows(spark):
    vocabulary = bpe.Vocabulary(spark, PATH, public_tokenizers.PATTERN)
    assert bpe.encode(spark.createDataFrame([], "text string"), vocabulary).count() == 0


def test_vocabulary_needs_all_bytes(spark, tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError, match="without a rank"):
        bpe.Vocabulary(spark, str(path), public_tokenizers.PATTERN)


def test_query(spark, sf_dir):
    import hashlib

    found = {r.doc_id: r for r in op1_byte_bpe(spark, sf_dir).collect()}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(texts)
    for doc_id, text in texts:
        expected = ORACLE.encode_ordinary(text or "")
        row = found[doc_id]
        assert row.n_tokens == len(expected)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, expected)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
