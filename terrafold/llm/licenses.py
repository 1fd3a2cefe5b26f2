"""License scans by a positional index of rare tokens.

Words of the templates and of the base phrases are weighed by their inverse document frequency over
the whole corpus, and an index holds their postings, word -> (template, place). Of the licence words
that a file has, those of highest idf are looked up: RARE for each template whose mandatory phrases
have all their words in the file, one for each base phrase. Every hit votes for (template, place in
file - place in template). Alignments that at least two distinct words agree on are verified: the
template's mandatory phrases must stand inside the aligned window, SLACK words wider on either side.
A base phrase must stand at the aligned place itself; each of its places has its rarest word, so none
is missed.

Words: A-Z are lower-cased and `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` taken.

Defined cases: null text counts as empty; a text without hits has 0, nulls, empty labels and score 0;
equal rows get equal results; an empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.store import bounded

RARE, SLACK = 5, 3

#: The same bytes as the word pattern in the text's UTF-8: every character past 0x7F counts.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: label: (text of the notice, mandatory phrases); phrases of the public licence notices.
TEMPLATES = {
    "agpl-3.0": ("licensed under the gnu affero general public license version 3", ["gnu affero general public license"]),
    "apache-2.0": ("licensed under the apache license version 2 0", ["apache license version 2 0"]),
    "arr": ("copyright all rights reserved", ["all rights reserved"]),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", ["redistribution and use in source and binary forms"]),
    "cc-by-4.0": ("licensed under cc by 4 0", ["cc by 4 0"]),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    "cc0-1.0": ("released under the cc0 1 0 universal public domain dedication", ["cc0"]),
    "gpl-2.0": ("licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify and or distribute this software"]),
    "lgpl-3.0": ("licensed under the gnu lesser general public license version 3", ["gnu lesser general public license"]),
    "mit": ("released under the mit license", ["mit license"]),
    "mit-text": ("permission is hereby granted free of charge to any person obtaining a copy of this software", ["permission is hereby granted free of charge"]),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    "unlicense": ("this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
}


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


@dataclass
class Template:
    label: str
    words: list[bytes]
    phrases: list[list[bytes]]
    base: bool
    rarest: list[bytes]
    needed: frozenset[bytes]


class Index:
    """Postings of the words of templates and base phrases."""

    def __init__(self, idf: dict[bytes, float]) -> None:
        self.templates, self.postings = [], defaultdict(list)
        known = [(label, text, phrases, False) for label, (text, phrases) in sorted(TEMPLATES.items())]
        for label, text, phrases, base in known + [(label, phrase, [phrase], True) for phrase, label in BASE.items()]:
            own, parts = words_of(text.encode()), [words_of(p.encode()) for p in phrases]
            rarest = sorted(set(own), key=lambda w: (-idf.get(w, 0.0), w))
            for place, w in enumerate(own):
                self.postings[w].append((len(self.templates), place))
            self.templates.append(Template(label, own, parts, base, rarest, frozenset(w for p in parts for w in p)))
        self.vocabulary = set(self.postings)

    def alignments(self, words: list[bytes]) -> dict[tuple[int, int], set[bytes]]:
        """(template, place in file where it would start): the looked-up words that agree on it."""
        present, votes = self.vocabulary.intersection(words), defaultdict(set)
        looked = defaultdict(set)
        for t, own in enumerate(self.templates):
            if own.needed <= present:
                for w in [w for w in own.rarest if w in present][: 1 if own.base else RARE]:
                    looked[w].add(t)
        if looked:
            places = {w: [(t, place) for t, place in self.postings[w] if t in of] for w, of in looked.items()}
            for i, w in enumerate(words):
                if w in places:
                    for t, place in places[w]:
                        votes[t, i - place].add(w)
        return votes

    def scan(self, text: bytes) -> dict:
        words = words_of(text)
        starts, base_labels, labels, score = [], set(), set(), 0.0
        for (t, at), agreed in self.alignments(words).items():
            own = self.templates[t]
            if own.base:
                if at >= 0 and words[at : at + len(own.words)] == own.words:
                    starts.append(at)
                    base_labels.add(own.label)
                    score = max(score, 0.5)
                continue
            if len(agreed) < min(2, len(own.rarest)) or own.label in labels and score == 1.0:
                continue
            window = words[max(0, at - SLACK) : max(0, at + len(own.words) + SLACK)]
            if all(_contains(window, p) for p in own.phrases):
                labels.add(own.label)
                same = sum(0 <= at + k < len(words) and words[at + k] == w for k, w in enumerate(own.words))
                score = max(score, same / len(own.words))
        return {
            "n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base_labels)), "labels": ",".join(sorted(labels | base_labels)), "score": score}


def _contains(words: list[bytes], phrase: list[bytes]) -> bool:
    n = len(phrase)
    return any(words[i : i + n] == phrase for i in range(len(words) - n + 1))


def licence_words() -> set[bytes]:
    """The words of all templates and base phrases."""
    return {w for text in [*(t for t, _ in TEMPLATES.values()), *BASE] for w in words_of(text.encode())}


def document_frequencies(docs: DataFrame) -> tuple[int, dict[bytes, int]]:
    """Rows, and in how many each licence word stands. As many sums reach the driver as there are licence words."""
    vocabulary = licence_words()

    def count(batches):
        df, n = Counter(), 0
        for b in batches:
            n += b.num_rows
            for text in b.column("text").cast(pa.binary()):
                df.update(vocabulary.intersection(words_of(text.as_py() or b"")))
        pairs = [("", n), *((w.decode(), k) for w, k in df.items())]
        yield pa.RecordBatch.from_pydict({"word": [p[0] for p in pairs], "n": pa.array([p[1] for p in pairs], pa.int64())})

    sums = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r.word.encode(): r.n for r in sums}
    return found.pop(b"", 0), found


_ROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    slim = bounded(docs).select(F.col("doc_id").cast("long"), "text")
    n, df = document_frequencies(slim)
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) for w in licence_words()}

    def find(batches):
        index = Index(idf)
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            rows = [{"doc_id": d} | index.scan(t.as_py() or b"") for d, t in zip(b.column("doc_id").to_pylist(), texts, strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=_ROW)

    kind = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return slim.mapInArrow(find, kind)
