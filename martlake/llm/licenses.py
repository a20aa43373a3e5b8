"""License notices: phrases in place, and an exact containment join of text blocks with notice templates.

A block is a line, or, where a line is longer than `SPAN` words, each of its windows of `SPAN` words that start half a
window apart. Since notices are often wrapped, the windows of the whole text that reach over a line break are blocks too. Any
`SPAN` / 2 words in a row, which is more than a template has, are in one window, and every block that matches counts. A block matches a template if it holds at least `threshold` of the template's distinct words. The
template words are counted over all documents and ordered from rare to frequent; a matching block must hold one of
the first words of that order (prefix filter), have enough words (length filter), and from the first common
word on still be able to reach the overlap (positional filter). What passes is compared on full sets, so
the join is exact. Templates and their counts are as small as the list below, whatever the corpus.

Defined cases: null and empty texts have no words and no labels; blocks never span texts; equal counts are
ordered by word; rows that repeat an id are judged each by its own text; without documents there are no counts and
no rows; only the id and the text are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import lean
from martlake.llm.textbytes import ALNUM, LOWER, Words, find_words, hash_words, pieces

#: The phrases that must be found in place, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Short notices by which works declare a license.
TEMPLATES = (
    ("mit", "released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("agpl", "GNU Affero General Public License"),
    ("lgpl", "GNU Lesser General Public License"),
    (
        "bsd-3-clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted",
    ),
    ("isc", "licensed under the ISC License"),
    ("cc0", "CC0 1.0 Universal"),
    ("epl", "Eclipse Public License"),
    *((name.split("-")[0].lower(), f"SPDX-License-Identifier: {name}") for name in ("MIT", "Apache-2.0", "GPL", "LGPL", "AGPL", "MPL-2.0", "EPL", "ISC", "CC0", "BSD")),
)

THRESHOLD = 0.9
#: Lines longer than this, and texts of several lines, are cut into windows; any half as many words in a row are in
#: one of them.
SPAN = 64

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def text_words(text: str) -> list[bytes]:
    return WORD.findall(text.encode().translate(bytes(LOWER)))


def hash_list(words: list[bytes]) -> np.ndarray:
    """The hash of each word, as it is hashed within a text."""
    edges = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    return hash_words(np.frombuffer(b"".join(words), dtype=np.uint8), edges[:-1], edges[1:])


class Vocabulary:
    """The words of all templates, found in texts by their hashes."""

    def __init__(self, templates: tuple[tuple[str, str], ...]):
        self.words = sorted({w for _, text in templates for w in text_words(text)})
        hashes = hash_list(self.words)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, or -1."""
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], -1)


def line_numbers(data: np.ndarray, words: Words) -> np.ndarray:
    """A number for each word's line; lines of different texts differ."""
    breaks = np.cumsum(data == 10)
    return breaks[words.start] + words.text if len(words.start) else np.zeros(0, dtype=np.int64)


def broken_windows(places: np.ndarray, lines: np.ndarray, words: Words) -> list[tuple[int, int]]:
    """First and last word (exclusive) of the windows of whole texts that hold one of the places and a line break."""
    step = SPAN // 2
    first = words.first[words.text[places]]
    number = (places - first) // step
    start = np.unique(np.concatenate([first + number * step, (first + (number - 1) * step)[number > 0]]))
    head, end = words.first[words.text[start]], words.first[words.text[start] + 1]
    start, end = (x[start < np.maximum(end - step, head + 1)] for x in (start, end))
    stop = np.minimum(start + SPAN, end)
    kept = lines[start] != lines[stop - 1]
    return list(zip(start[kept].tolist(), stop[kept].tolist(), strict=True))


def word_counts(docs: DataFrame, templates: tuple[tuple[str, str], ...], text_col: str = "text") -> DataFrame:
    """How many words of all texts are each template word: (word, n), one row per template word at most."""
    vocabulary = Vocabulary(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(vocabulary.words), dtype=np.int64)
        for batch in batches:
            for piece in pieces(batch.column(0)):
                data = LOWER[piece.data]
                words = find_words(piece, data, ALNUM)
                found = vocabulary.find(hash_words(data, words.start, words.end))
                counts += np.bincount(found[found >= 0], minlength=len(counts))
        names = [w.decode() for w in vocabulary.words]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts)], names=["word", "n"])

    partial = docs.select(F.col(text_col).alias("text")).mapInArrow(lean(run), "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


class Join:
    """The templates as sets in global frequency order, with an index of their prefixes."""

    def __init__(self, templates: tuple[tuple[str, str], ...], counts: dict[str, int], threshold: float):
        self.vocabulary = Vocabulary(templates)
        numbers = {w: k for k, w in enumerate(self.vocabulary.words)}
        self.labels = [label for label, _ in templates]
        self.sets, self.needed = [], []
        self.prefixes: dict[int, list[tuple[int, int]]] = {}
        for t, (_, text) in enumerate(templates):
            ranked = sorted(set(text_words(text)), key=lambda w: (counts.get(w.decode(), 0), w))
            own = [numbers[w] for w in ranked]
            needed = math.ceil(threshold * len(own) - 1e-9)
            self.sets.append(own)
            self.needed.append(needed)
            for place, word in enumerate(own[: len(own) - needed + 1]):
                self.prefixes.setdefault(word, []).append((t, place))
        self.is_prefix = np.isin(np.arange(len(numbers)), list(self.prefixes))

    def block(self, words: np.ndarray) -> list[tuple[int, float]]:
        """Templates that a block of word numbers (-1: in no template) contains, with their containment."""
        held = set(words[words >= 0].tolist())
        first: dict[int, int] = {}
        for word in held & self.prefixes.keys():
            for t, place in self.prefixes[word]:
                first[t] = min(place, first.get(t, place))
        found = []
        for t, place in sorted(first.items()):
            own, needed = self.sets[t], self.needed[t]
            if len(held) < needed or len(own) - place < needed:
                continue
            overlap = sum(w in held for w in own[place:])
            if overlap >= needed:
                found.append((t, overlap / len(own)))
        return found

    def line(self, words: np.ndarray) -> list[tuple[int, float, int, int]]:
        """Matches of a line's blocks: template, containment, first word and number of words."""
        found = []
        for i in range(0, max(1, len(words) - SPAN // 2), SPAN // 2):
            part = words[i : i + SPAN]
            found += [(t, share, i, len(part)) for t, share in self.block(part)]
        return found


def phrase_places(hashes: np.ndarray, words: Words) -> list[tuple[str, np.ndarray]]:
    """Where each phrase starts, as places among all words of a piece."""
    out = []
    for phrase, label in PHRASES.items():
        parts = hash_list([w.encode() for w in phrase.split()])
        n = len(hashes) - len(parts) + 1
        if n <= 0:
            continue
        hit = np.flatnonzero(hashes[:n] == parts[0])
        for k in range(1, len(parts)):
            hit = hit[(hashes[hit + k] == parts[k]) & (words.text[hit + k] == words.text[hit])]
        out.append((label, hit))
    return out


SPANS = "array<struct<label:string,template:int,containment:double,first_word:long,n_words:long>>"
RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    f" score double, spans {SPANS}"
)
SPAN_TYPE = pa.list_(
    pa.struct(
        [
            ("label", pa.string()),
            ("template", pa.int32()),
            ("containment", pa.float64()),
            ("first_word", pa.int64()),
            ("n_words", pa.int64()),
        ]
    )
)


def scan_texts(texts: pa.Array, join: Join) -> list[pa.Array]:
    n = len(texts)
    counts, base = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    first, last = [None] * n, [None] * n
    base_labels: list[set[str]] = [set() for _ in range(n)]
    spans: list[list[dict]] = [[] for _ in range(n)]
    for piece in pieces(texts):
        data = LOWER[piece.data]
        words = find_words(piece, data, ALNUM)
        hashes = hash_words(data, words.start, words.end)
        counts[piece.first : piece.first + piece.n] = np.diff(words.first)
        for label, hits in phrase_places(hashes, words):
            for hit in hits.tolist():
                k = int(words.text[hit])
                at, k = hit - int(words.first[k]), k + piece.first
                base[k] += 1
                base_labels[k].add(label)
                first[k] = at if first[k] is None else min(first[k], at)
                last[k] = at if last[k] is None else max(last[k], at)
        numbers = join.vocabulary.find(hashes)
        lines = line_numbers(data, words)
        starts = np.flatnonzero(np.isin(numbers, np.flatnonzero(join.is_prefix)))
        matches: list[tuple[int, float, int, int]] = []
        for line in np.unique(lines[starts]):
            i, j = np.searchsorted(lines, [line, line + 1])
            matches += [(t, share, int(i) + at, width) for t, share, at, width in join.line(numbers[i:j])]
        for i, j in broken_windows(starts, lines, words):
            matches += [(t, share, i, j - i) for t, share in join.block(numbers[i:j])]
        for t, share, at, width in matches:
            k = int(words.text[at])
            spans[piece.first + k].append(
                {
                    "label": join.labels[t],
                    "template": t,
                    "containment": share,
                    "first_word": at - int(words.first[k]),
                    "n_words": width,
                }
            )
    labels = [sorted(b | {s["label"] for s in own}) for b, own in zip(base_labels, spans, strict=True)]
    scores = [
        1.0 if b else max((s["containment"] for s in own), default=0.0) for b, own in zip(base_labels, spans, strict=True)
    ]
    return [
        pa.array(counts),
        pa.array(base),
        pa.array(first, pa.int64()),
        pa.array(last, pa.int64()),
        pa.array([",".join(sorted(b)) for b in base_labels]),
        pa.array([",".join(x) for x in labels]),
        pa.array(scores, pa.float64()),
        pa.array(spans, SPAN_TYPE),
    ]


def license_scan(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """For every document its words, phrase places, labels, score and the spans that match a template."""
    counts = {r["word"]: r["n"] for r in word_counts(docs, templates, text_col).collect()}  # template words only
    join = Join(templates, counts, threshold)
    names = [part.split()[0] for part in RESULT.split(f" spans {SPANS}")[0].rstrip(",").split(", ")] + ["spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *scan_texts(batch.column(1), join)], names=names)

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(lean(run), RESULT)
