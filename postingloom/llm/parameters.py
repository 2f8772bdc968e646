"""Production parameters of the registered queries and the pipeline."""

from __future__ import annotations

#: Shingles of three words; fingerprints that differ in two bits or fewer link.
SIMHASH = {"shingle": 3, "distance": 2}

#: Weights of the sources in turn, per cent of all words, most copies of a word.
MIX = {"weights": (3, 1, 2), "percent": 150, "most": 2}

RANK_FILE = "byte_bpe_multi_50k.tiktoken"

#: Cosine from which vectors link; reference points, nearest of them kept, and how many must be shared.
EMBEDDING = {"cosine": 0.95, "n_pivots": 1024, "prefix": 8, "shared": 3}

#: Tokens of a run and pages that share it for it to be boilerplate.
HTML = {"run": 10, "min_pages": 3}

#: Messages of a dialogue in one row.
CHAT = {"context": ("system",), "part_turns": 1024}

#: Pages per archive file, date of the records. One record in 97 of the replica is altered, one in 101 missing.
WARC = {"pages_per_file": 256, "date": "2026-01-01T00:00:00Z", "altered": 97, "missing": 101}

#: Fields of a leaf in their order, what trees are of, what orders leaves. One document in so many is tampered with.
MANIFEST = {"fields": ["doc_id", "source", "lang", "n_chars", "text"], "source": "source", "key": "doc_id", "tampered": 5}

#: Documents of a language that a term must be in, and terms reported for each source.
DIVERGENCE = {"least_docs": 10, "top": 10}

#: Share of a template's words that a text must have, and words by which each may be off its place.
LICENCES = {"share": 0.8, "drift": 2}
