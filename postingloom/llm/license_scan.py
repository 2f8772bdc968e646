"""Licence notices in texts: rare words look up templates, words at their relative places confirm them."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postingloom.llm.common import shipped, text_or_empty

#: ASCII digits and letters and every byte of a longer character; in UTF-8 the same runs as [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass(frozen=True)
class Template:
    """A passage and the phrases that a text must have in it, word for word."""

    label: str
    passage: str
    phrases: tuple[str, ...]


#: Phrases that count wherever their words stand side by side, with their labels. Fixed values.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices of common licences, as their texts ask for them. Fixed values.
TEMPLATES = (
    Template("agpl-3.0", "under the terms of the gnu affero general public license as published by the free software foundation", ("affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "2 0")),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use", "source and binary forms")),
    Template("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission", ("endorse or promote products",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright",)),
    Template("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license", "version 2")),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license", "version 3")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted", "free of charge")),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)


@dataclass
class Index:
    """Templates as numbers of words, and for each rare word where in which templates it stands.

    A template is found at a place if at least ``share`` of its words stand there, each at most ``drift`` words from its
    own place. Of L words with n needed, some n-th is among any L - n + 1; the rarest so many words are looked up, so no place
    is missed."""

    templates: tuple[Template, ...]
    phrases: dict[str, str]
    documents: dict[str, int]
    share: float
    drift: int
    numbers: dict[bytes, int] = field(init=False)
    passages: list[np.ndarray] = field(init=False)
    needed: list[int] = field(init=False)
    postings: dict[int, list[tuple[int, int]]] = field(init=False)
    rare: np.ndarray = field(init=False)
    bases: list[tuple[str, np.ndarray]] = field(init=False)
    asked: list[list[np.ndarray]] = field(init=False)

    def __post_init__(self) -> None:
        self.numbers = {word.encode(): k + 1 for k, word in enumerate(licence_words(self.templates, self.phrases))}
        self.passages = [self._numbered(t.passage) for t in self.templates]
        self.asked = [[self._numbered(phrase) for phrase in t.phrases] for t in self.templates]
        self.bases = [(label, self._numbered(phrase)) for phrase, label in self.phrases.items()]
        self.needed = [math.ceil(self.share * len(passage)) for passage in self.passages]
        self.postings = {}
        for k, (template, needed) in enumerate(zip(self.templates, self.needed, strict=True)):
            words = template.passage.split()
            rarest = sorted(range(len(words)), key=lambda q: (self.documents.get(words[q], 0), words[q], q))  # noqa: B023
            for q in rarest[: len(words) - needed + 1]:
                self.postings.setdefault(int(self.passages[k][q]), []).append((k, q))
        self.rare = np.zeros(len(self.numbers) + 1, bool)
        self.rare[list(self.postings)] = True

    def _numbered(self, words: str) -> np.ndarray:
        return np.array([self.numbers[word.encode()] for word in words.split()])

    def read(self, text: bytes) -> np.ndarray:
        """The number of each word of a text, 0 for words of no licence."""
        words = _WORD.findall(text.lower())  # bytes: lowers A-Z only
        return np.fromiter(map(self.numbers.get, words, repeat(0)), np.int32, len(words))

    def base_places(self, words: np.ndarray) -> list[tuple[int, str]]:
        return [(int(at), label) for label, phrase in self.bases for at in places_of(phrase, words)]

    def found(self, words: np.ndarray) -> list[tuple[str, int, float]]:
        """(label, place, share) of each template at its best place, the first of equal ones."""
        looked_up: dict[int, list[np.ndarray]] = {}
        hits = np.flatnonzero(self.rare[words])
        for number in np.unique(words[hits]):
            at = hits[words[hits] == number]
            for k, q in self.postings[int(number)]:
                looked_up.setdefault(k, []).append(at - q)
        best = []
        for k, offsets in sorted(looked_up.items()):
            near = np.unique(np.concatenate(offsets)[:, None] + np.arange(-self.drift, self.drift + 1))
            matched = self._matched(k, words, near)
            enough = matched >= self.needed[k]
            for phrase in self.asked[k]:
                enough &= self._within(phrase, words, near, len(self.passages[k]))
            if enough.any():
                top = int(np.argmax(np.where(enough, matched, 0)))
                best.append((self.templates[k].label, int(near[top]), float(matched[top] / len(self.passages[k]))))
        return best

    def _matched(self, k: int, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Words of the template that stand near their places, for each offset."""
        passage, margin = self.passages[k], len(self.passages[k]) + self.drift
        padded = np.concatenate([np.zeros(margin, np.int32), words, np.zeros(margin, np.int32)])
        matched = np.zeros(len(offsets), np.int64)
        for q, number in enumerate(passage):
            stands = np.zeros(len(offsets), bool)
            for d in range(-self.drift, self.drift + 1):
                at = offsets + q + d + margin
                inside = (at >= 0) & (at < len(padded))
                stands |= inside & (padded[np.where(inside, at, 0)] == number)
            matched += stands
        return matched

    def _within(self, phrase: np.ndarray, words: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
        """Whether the phrase stands whole between each offset and the end of the passage there, ``drift`` words more on both sides."""
        places = places_of(phrase, words)
        first = np.searchsorted(places, offsets - self.drift)
        last = np.searchsorted(places, offsets + length + self.drift - len(phrase), side="right")
        return last > first


def places_of(phrase: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Where the words of the phrase stand side by side, in order."""
    n = len(words) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(words[:n] == phrase[0])
    for q, number in enumerate(phrase[1:], 1):
        at = at[words[at + q] == number]
    return at


def licence_words(templates: tuple[Template, ...], phrases: dict[str, str]) -> list[str]:
    texts = [*phrases, *(t.passage for t in templates), *(p for t in templates for p in t.phrases)]
    return sorted({word for text in texts for word in text.split()})


def document_counts(documents: DataFrame, wanted: list[str], text: str = "text") -> dict[str, int]:
    """In how many documents each of the wanted words is, over all documents. There are as many as the templates have words."""
    known = frozenset(word.encode() for word in wanted)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                counts.update(known.intersection(_WORD.findall(value.as_py().lower())))
        yield pa.RecordBatch.from_pydict({"word": [w.decode() for w in counts], "n": pa.array(counts.values(), pa.int64())},
                                         schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))

    counted = documents.select(text_or_empty(text).cast("binary")).mapInArrow(partial, "word string, n bigint")
    return {row.word: row.n for row in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


_FOUND = "struct<n_words:bigint,bases:array<struct<start:bigint,label:string>>,templates:array<struct<label:string,start:bigint,share:double>>>"


def found_column(text: str | Column, index: Index) -> Column:
    kind = pa.struct([
        ("n_words", pa.int64()),
        ("bases", pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))),
        ("templates", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())]))),
    ])

    @F.arrow_udf(_FOUND)
    def licences(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts:
            words = index.read(value.as_py())
            rows.append({
                "n_words": len(words),
                "bases": [{"start": start, "label": label} for start, label in sorted(index.base_places(words))],
                "templates": [{"label": label, "start": start, "share": share} for label, start, share in index.found(words)],
            })
        return pa.array(rows, kind)

    return licences(text_or_empty(text).cast("binary"))


def scan(
    documents: DataFrame,
    share: float,
    drift: int,
    templates: tuple[Template, ...] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, bases, templates), one row per row of ``documents``.

    bases has (start, label) of every place of a fixed phrase, templates (label, start, share) of each template that the text has: at least
    ``share`` of its words, each within ``drift`` words of its place, and its mandatory phrases whole. Each is given at its best
    place, the first of equal ones; a passage that the text begins or ends within may start before word 0.
    Which words are rare is counted over all documents; it decides how much is looked at, never what is found. A null or empty text has no words
    and no licence. A missing doc_id stays null, repeated rows come out repeated. Work is linear in a text's words, however long or repetitive
    it is. Only doc_id and text are read, so further columns may have any name. No rows give no rows."""
    index = Index(templates, phrases, document_counts(documents, licence_words(templates, phrases), text), share, drift)
    found = documents.select(F.col(doc_id).alias("doc_id"), found_column(text, index).alias("found"))
    return found.select("doc_id", "found.*")


def labels(names: Column) -> Column:
    """Names once each, in order, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(names)), ",")


shipped(__name__)
