"""License scans by an exact set-similarity join of text blocks with license templates.

A block is a window of consecutive words, twice as many as the template has, at any place of the
text (or the text, if that is shorter). A block matches a template if it holds at least
``THRESHOLD`` of the template's distinct tokens.

The tokens of the templates are ordered by how many documents of the whole corpus have them,
rarest first (one pass over the texts; its result is as small as the templates). Of a template of
m tokens that must share n, any n have one among the m - n + 1 rarest, the prefix. So only the
surroundings of prefix tokens are looked at; surroundings of fewer than n words are out (length
filter), and so are those where the place of the first shared token in the order leaves too few
behind it (positional filter). In what remains the block slides over the template's tokens, with
counts that change by the words that come in and go out. No matching block is lost: one that starts
between two tokens holds no more than the one that starts at the second. Matching blocks that
overlap are reported as one, with the largest share of any of them.

Base phrases are reported with every place they stand at, whatever the templates say.

Defined cases: a null text is an empty one; a template without words is never found; equal
templates under two labels give both; repeated rows are scanned one by one; score is the largest
share of a matched template's tokens, 0 without a match.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.llm.arrow import ALNUM_WORDS, append, as_bytes, col, slices

THRESHOLD = 0.8

# The base phrases and their labels; naming sentences, headers and bodies of licenses.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
TEMPLATES = (
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU Affero General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a "
     "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
     "applicable law or agreed to in writing, software distributed under the License is distributed "
     "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer. Redistributions in binary form must reproduce the "
     "above copyright notice, this list of conditions and the following disclaimer in the "
     "documentation and/or other materials provided with the distribution."),
    ("bsd", "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
     "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
     "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
     "INTERRUPTION)"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation; either "
     "version 2 of the License, or (at your option) any later version."),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the "
     "terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
     "either version 2.1 of the License, or (at your option) any later version."),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files"),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
     "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
     "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
     "ANY CLAIM, DAMAGES OR OTHER LIABILITY"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is "
     "free to copy, modify, publish, use, compile, sell, or distribute this software"),
)

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "base_places",
            T.ArrayType(T.StructType([T.StructField("at", T.LongType()), T.StructField("label", T.StringType())])),
        ),
        T.StructField(
            "license_blocks",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType()),
                        T.StructField("label", T.StringType()),
                        T.StructField("share", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM_WORDS).split()


class Template(NamedTuple):
    """Its tokens' places in global frequency order, how many it needs, and its block's width."""

    label: str
    place: dict[bytes, int]
    need: int
    width: int


class TemplateIndex:
    """Templates as tokens in global frequency order, and an index of their prefixes."""

    def __init__(self, templates, phrases, frequency: dict[bytes, int], threshold: float):
        self.order: list[Template] = []
        self.prefixes: dict[bytes, list[int]] = {}
        for label, text in templates:
            words = words_of(text.encode())
            tokens = sorted(set(words), key=lambda w: (frequency.get(w, 0), w))
            if not tokens:
                continue
            need = max(1, math.ceil(threshold * len(tokens) - 1e-9))
            for token in tokens[: len(tokens) - need + 1]:
                self.prefixes.setdefault(token, []).append(len(self.order))
            place = {token: i for i, token in enumerate(tokens)}
            self.order.append(Template(label, place, need, 2 * len(words)))
        self.phrases: dict[bytes, list[tuple[list[bytes], str]]] = {}
        for phrase, label in phrases:
            words = words_of(phrase.encode())
            self.phrases.setdefault(words[0], []).append((words, label))
        self.watched = frozenset(self.prefixes) | frozenset(self.phrases)

    def scan(self, words: list[bytes]) -> tuple[list, list]:
        """Places of base phrases, and matching blocks."""
        seen = self.watched.intersection(words)
        if not seen:
            return [], []
        places: list[dict] = []
        near: dict[int, list[int]] = {}
        for at, word in enumerate(words):
            if word not in seen:
                continue
            for phrase, label in self.phrases.get(word, ()):
                if words[at : at + len(phrase)] == phrase:
                    places.append({"at": at, "label": label})
            for t in self.prefixes.get(word, ()):
                near.setdefault(t, []).append(at)
        blocks = [block for t in sorted(near) for block in self.blocks(self.order[t], words, near[t])]
        return places, sorted(blocks, key=lambda b: (b["start"], b["end"], b["label"]))

    def blocks(self, template: Template, words: list[bytes], near: list[int]) -> Iterator[dict]:
        """The stretches of blocks that match a template, around the places of its prefix tokens."""
        place, need, width = template.place, template.need, template.width
        for start, end in _surroundings(near, width, len(words)):
            if end - start < need:
                continue
            found = [(i, place[words[i]]) for i in range(start, end) if words[i] in place]
            shared = {rank for _, rank in found}
            if len(place) - min(shared) < need or len(shared) < need:
                continue
            counts = [0] * len(place)
            distinct = right = 0
            stretch: list | None = None
            for at, rank in found:
                while right < len(found) and found[right][0] < at + width:
                    distinct += not counts[found[right][1]]
                    counts[found[right][1]] += 1
                    right += 1
                if distinct >= need:
                    until = min(at + width, len(words))
                    if stretch and at < stretch[1]:
                        stretch = [stretch[0], until, max(stretch[2], distinct)]
                    else:
                        if stretch:
                            yield _block(template, *stretch)
                        stretch = [at, until, distinct]
                counts[rank] -= 1
                distinct -= not counts[rank]
            if stretch:
                yield _block(template, *stretch)


def _block(template: Template, start: int, end: int, shared: int) -> dict:
    return {"start": start, "end": end, "label": template.label, "share": shared / len(template.place)}


def _surroundings(places: list[int], width: int, length: int) -> Iterator[tuple[int, int]]:
    """The stretches of words that blocks with one of the ascending places can cover."""
    start, end = 0, -1
    for place in places:
        low, high = max(0, place - width + 1), min(length, place + width)
        if low <= end:
            end = high
            continue
        if end >= 0:
            yield start, end
        start, end = low, high
    yield start, end


def document_frequency(docs: DataFrame, vocabulary: set[bytes], text: str = "text") -> dict[bytes, int]:
    """In how many documents each word of a small vocabulary stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _frequency_batch(batches, vocabulary)

    schema = "word binary, docs long"
    rows = docs.select(col(text).alias("text")).mapInArrow(count, schema)
    # One row for each word of the vocabulary at most.
    return {bytes(r[0]): r[1] for r in rows.groupBy("word").agg(F.sum("docs")).collect()}


def _frequency_batch(batches: Iterator[pa.RecordBatch], vocabulary: set[bytes]) -> pa.RecordBatch:
    total: Counter[bytes] = Counter()
    for batch in batches:
        for part in slices(batch, 0):
            for text in as_bytes(part.column(0)):
                total.update(vocabulary.intersection(words_of(text)))
    return pa.RecordBatch.from_arrays(
        [pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64())],
        names=["word", "docs"],
    )


# The index of the templates at hand, kept by a Python worker between its tasks.
_INDEX: dict[str, TemplateIndex] = {}


def _index(key: str, *options) -> TemplateIndex:
    if key not in _INDEX:
        _INDEX.clear()
        _INDEX[key] = TemplateIndex(*options)
    return _INDEX[key]


def _arrays(index: TemplateIndex, texts: list[bytes]) -> list[pa.Array]:
    split = [words_of(text) for text in texts]
    found = [index.scan(words) for words in split]
    place = pa.struct([("at", pa.int64()), ("label", pa.string())])
    block = pa.struct(
        [("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("share", pa.float64())]
    )
    return [
        pa.array(map(len, split), pa.int64()),
        pa.array([f[0] for f in found], pa.list_(place)),
        pa.array([f[1] for f in found], pa.list_(block)),
    ]


def scan(
    docs: DataFrame,
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    threshold: float = THRESHOLD,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with n_words, base_places (word index, label) and license_blocks (words, share)."""
    vocabulary = {w for _, body in templates for w in words_of(body.encode())}
    frequency = document_frequency(docs, vocabulary, text)
    key = uuid.uuid4().hex

    def compute(texts: pa.Array) -> list[pa.Array]:
        return _arrays(_index(key, templates, phrases, frequency, threshold), as_bytes(texts))

    return append(docs, [text], compute, FOUND, keep)
