"""Byte-level BPE: text to token ids by merge ranks, and ids back to bytes."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterable
from heapq import heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postingloom.llm.common import bounded_batches, shipped

#: Pre-tokens up to this many characters are remembered, and so many of them at a time.
REMEMBERED_CHARS, REMEMBERED = 64, 600_000
#: Rows of a batch that are worked on at once.
CHUNK = 500


class RankQueue:
    """Positions by merge rank, lowest rank first and within it the leftmost position.

    A bucket per rank holds positions. Two levels of bitmaps mark the buckets in use: a
    word has a bit for each of its ranks, the top one for each word that has a bit. The
    first set bits of both lead to the lowest rank. It is empty between two pre-tokens
    and used again.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        n_ranks = max(ranks.values()) + 1
        self.ranks = ranks
        self.shift = max(1, (n_ranks.bit_length() + 1) // 2)
        self.words = [0] * ((n_ranks >> self.shift) + 1)
        self.bits = [1 << k for k in range(max(1 << self.shift, len(self.words)))]
        self.buckets: dict[int, int | list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token.

        Parts form a linked list over byte positions. The pair of lowest rank goes
        first; a pair that has changed since it was queued is stale and skipped.
        """
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        buckets, words, bits, shift = self.buckets, self.words, self.bits, self.shift
        mask = (1 << shift) - 1
        top = 0
        after = [*range(1, n + 2)]  # start of the next part
        before = [*range(-1, n)]
        pair_rank = [rank_of(piece[at : at + 2], -1) for at in range(n - 1)]  # of a part joined with the next one
        pair_rank.append(-1)
        fresh = [(rank, at) for at, rank in enumerate(pair_rank) if rank >= 0]
        while True:
            for rank, at in fresh:
                if rank in buckets:
                    bucket = buckets[rank]
                    if bucket.__class__ is list:
                        heappush(bucket, at)
                    else:
                        buckets[rank] = [bucket, at] if bucket < at else [at, bucket]
                else:
                    buckets[rank] = at
                    word = rank >> shift
                    words[word] |= bits[rank & mask]
                    top |= bits[word]
            if not top:
                break
            word = (top & -top).bit_length() - 1
            marks = words[word]
            rank = word << shift | (marks & -marks).bit_length() - 1
            at = buckets[rank]
            if at.__class__ is list and len(at) > 1:
                at = heappop(at)
            else:
                del buckets[rank]
                if at.__class__ is list:
                    at = at[0]
                words[word] = marks = marks & marks - 1
                if not marks:
                    top &= top - 1
            fresh = []
            if pair_rank[at] != rank:
                continue
            gone = after[at]
            pair_rank[gone] = -1
            end = after[at] = after[gone]
            joined = -1
            if end < n:
                before[end] = at
                joined = rank_of(piece[at : after[end]], -1)
                if joined >= 0:
                    fresh.append((joined, at))
            pair_rank[at] = joined
            left = before[at]
            if left >= 0:
                pair_rank[left] = joined = rank_of(piece[left:end], -1)
                if joined >= 0:
                    fresh.append((joined, left))
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[piece[at : after[at]]])
            at = after[at]
        return ids


class KnownPieces(dict):
    """Packed ids by pre-token, made when first asked for; holds a bounded number of short ones."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.merge = RankQueue(ranks).merge

    def __missing__(self, piece: str) -> bytes:
        packed = array("i", self.merge(piece.encode())).tobytes()
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed


class Encoder:
    """Encodes texts, each match of the pattern by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pieces = regex.compile(pattern).findall
        self.known = KnownPieces(ranks)

    def packed(self, text: str) -> bytes:
        """The ids as 32-bit numbers in the machine's byte order."""
        return b"".join(map(self.known.__getitem__, self.pieces(text)))


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 token and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Vocabulary:
    """Merge ranks and the pre-token pattern, sent to the executors once.

    Its size is that of the vocabulary file and does not grow with the data."""

    def __init__(self, spark: SparkSession, path: str, pattern: str) -> None:
        ranks = read_ranks(path)
        missing = [byte for byte in range(256) if bytes([byte]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a rank: {missing[:5]}")
        bounded_batches(spark)
        # A worker keeps the value between tasks, and in it what it makes of the ranks.
        self.sent = spark.sparkContext.broadcast({"ranks": ranks, "pattern": pattern})

    def encode(self, text: str | Column) -> Column:
        """Token ids of a text column as array<int>; null text has no ids."""
        sent = self.sent

        @F.arrow_udf("array<int>")
        def bpe_encode(texts: pa.Array) -> pa.Array:
            encoder = _encoder(sent.value)
            return _by_chunks(texts, lambda chunk: encode_batch(encoder, chunk.to_pylist()))

        return bpe_encode(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))

    def decode(self, ids: str | Column) -> Column:
        """Bytes of an array<int> of token ids; null ids and null elements give no bytes.

        An id outside the vocabulary raises an error."""
        sent = self.sent

        @F.arrow_udf("binary")
        def bpe_decode(given: pa.Array) -> pa.Array:
            tokens = _tokens(sent.value)
            return _by_chunks(given, lambda chunk: decode_batch(tokens, chunk))

        given = F.col(ids) if isinstance(ids, str) else ids
        return bpe_decode(F.coalesce(F.array_compact(given), F.array().cast("array<int>")))


def _by_chunks(rows: pa.Array, work: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """The batch in pieces of CHUNK rows, which bounds what is held besides the batch itself."""
    pa.default_memory_pool().release_unused()  # what the batch before has left
    return pa.concat_arrays([work(rows.slice(start, CHUNK)) for start in range(0, max(1, len(rows)), CHUNK)])


def _encoder(sent: dict) -> Encoder:
    if "encoder" not in sent:
        sent["encoder"] = Encoder(sent["ranks"], sent["pattern"])
    return sent["encoder"]


def _tokens(sent: dict) -> pa.Array:
    """The bytes of each id in turn."""
    if "tokens" not in sent:
        by_rank = {rank: token for token, rank in sent["ranks"].items()}
        sent["tokens"] = pa.array([by_rank.get(rank) for rank in range(max(by_rank) + 1)], pa.large_binary())
    return sent["tokens"]


def encode(frame: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """Add the token ids of ``text``. A null or empty text has no ids; a column named ``ids`` is replaced.

    Rows are independent: repeated rows, ties and extra columns pass through."""
    return frame.withColumn(ids, vocabulary.encode(text))


def decode(frame: DataFrame, vocabulary: Vocabulary, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """Add the bytes that ``ids`` stand for; a column named ``decoded`` is replaced."""
    return frame.withColumn(decoded, vocabulary.decode(ids))


def encode_batch(encoder: Encoder, texts: Iterable[str]) -> pa.ListArray:
    rows = [encoder.packed(text) for text in texts]
    ends = pa.array(accumulate((len(row) // 4 for row in rows), initial=0), pa.int32())
    packed = b"".join(rows)
    return pa.ListArray.from_arrays(
        ends, pa.Array.from_buffers(pa.int32(), len(packed) // 4, [None, pa.py_buffer(packed)])
    )


def decode_batch(tokens: pa.Array, ids: pa.ListArray) -> pa.Array:
    """Take every token's bytes at once; a row's bytes then lie side by side in one buffer."""
    flat = ids.flatten()
    if pc.any(pc.or_(pc.less(flat, 0), pc.greater_equal(flat, len(tokens)))).as_py():
        raise ValueError("a token id outside the vocabulary")
    taken = tokens.take(flat)
    if taken.null_count:
        raise ValueError("a token id without a token")
    lengths = np.asarray(ids.value_lengths().fill_null(0))
    rows = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    starts = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)[rows] if len(taken) else rows
    data = taken.buffers()[2] if len(taken) else pa.py_buffer(b"")
    return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(starts), data]).cast(pa.binary())


shipped(__name__)
