"""License notices found by an exact set-similarity join.

A template is a notice or a paragraph of a license text. It matches a document
in which some block of consecutive words, twice as long as the template, holds
at least ``THRESHOLD`` of its distinct words; blocks begin at every word, so a
notice is found wherever it stands. The join is exact and filters by the usual
three bounds, with words in one global order, rarest first, by their counts over
all documents:

* prefix: to hold c of a template's n words, a block must hold one of the
  n - c + 1 rarest; only documents with one of those words go on, and only
  blocks around one;
* length: words of the template in reach of it must be c or more;
* position: from the rarest word in common, what is left of the template after
  it must still reach c.

The templates are public license texts, so their index travels with the code;
documents are read twice (counts, then the join) and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import columns, lean, ship, text_bytes

STRETCH = 2
THRESHOLD = 0.9

# Phrases that name a license, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Short notices and paragraphs of the licenses as their stewards publish them.
TEMPLATES = (
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation "
            "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
            "permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to "
            "the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the "
            "authors or copyright holders be liable for any claim damages or other liability whether in an action of "
            "contract tort or otherwise arising from out of or in connection with the software or the use or other "
            "dealings in the software"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
               "with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless "
               "required by applicable law or agreed to in writing software distributed under the license is distributed "
               "on an as is basis without warranties or conditions of any kind either express or implied see the license "
               "for the specific language governing permissions and limitations under the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation either version 3 of the license or at your "
            "option any later version"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the "
            "implied warranty of merchantability or fitness for a particular purpose see the gnu general public license "
            "for more details"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
            "following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission"),
)

# Bytes that are not part of a word become spaces; A-Z become a-z.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters."""
    return text.translate(_TABLE).split()


class Index:
    """Templates as ranks of the global order, rarest first, and their prefixes."""

    def __init__(self, templates, counts: dict[bytes, int], threshold: float, stretch: int = STRETCH):
        texts = [(label, words_of(text.encode())) for label, text in templates]
        order = sorted({w for _, t in texts for w in t}, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i + 1 for i, w in enumerate(order)}  # 0: not a template word
        self.templates = []
        self.is_prefix = np.zeros(len(order) + 1, bool)
        for label, t in texts:
            ranks = np.array(sorted({self.rank[w] for w in t}), np.int64)
            need = math.ceil(threshold * len(ranks) - 1e-9)
            prefix = np.zeros(len(order) + 1, bool)
            prefix[ranks[:len(ranks) - need + 1]] = True
            member = np.zeros(len(order) + 1, bool)
            member[ranks] = True
            self.is_prefix |= prefix
            self.templates.append((label, ranks, member, prefix, need, stretch * len(t)))

    def match(self, ranks: np.ndarray) -> dict[int, float]:
        """Template -> its best containment in a block of a document's words,
        for those that a block holds well enough."""
        out: dict[int, float] = {}
        found = np.zeros(len(self.is_prefix), bool)
        found[ranks] = True
        for k, (_, own, member, prefix, need, width) in enumerate(self.templates):
            here = np.flatnonzero(found[own])
            # Length, and position: what is left of the template from its rarest word here on.
            if len(here) < need or len(own) - here[0] < need or not found[own[:len(own) - need + 1]].any():
                continue
            at = np.flatnonzero(member[ranks])
            near = np.flatnonzero(prefix[ranks[at]])
            # Only what a block with a prefix word can reach.
            reach = np.zeros(len(at) + 1, np.int64)
            np.add.at(reach, np.searchsorted(at, at[near] - width, "right"), 1)
            np.add.at(reach, np.searchsorted(at, at[near] + width, "left"), -1)
            at = at[np.cumsum(reach[:-1]) > 0]
            most = _most_distinct(at.tolist(), ranks[at].tolist(), width)
            if most >= need:
                out[k] = most / len(own)
        return out


def _most_distinct(at: list[int], rank: list[int], width: int) -> int:
    """Most different ranks within ``width`` consecutive words, over all starts."""
    held: dict[int, int] = {}
    best = first = 0
    for place, r in zip(at, rank):
        held[r] = held.get(r, 0) + 1
        while at[first] <= place - width:
            held[rank[first]] -= 1
            if not held[rank[first]]:
                del held[rank[first]]
            first += 1
        best = max(best, len(held))
    return best


def scan_text(text: bytes, index: Index, phrases) -> tuple:
    words = words_of(text)
    n = len(words)
    rank = index.rank.get
    ranks = np.fromiter((rank(w, 0) for w in words), np.int64, n)
    places, base = [], set()
    for parts, first, label in phrases:
        for at in np.flatnonzero(ranks == first).tolist() if first else [i for i, w in enumerate(words) if w == parts[0]]:
            if words[at:at + len(parts)] == parts:
                places.append(at)
                base.add(label)
    labels, best = set(base), 1.0 if base else 0.0
    if n and index.is_prefix[ranks].any():
        for k, share in index.match(ranks).items():
            labels.add(index.templates[k][0])
            best = max(best, share)
    return (n, len(places), min(places) if places else None, max(places) if places else None,
            ",".join(sorted(base)), ",".join(sorted(labels)), best)


def word_counts(docs: DataFrame, words: frozenset[bytes], text_col: str = "text") -> dict[bytes, int]:
    """How often each of a few given words occurs in all texts."""
    ship(docs.sparkSession)
    listed = sorted(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.licenses import words_of

        at = {w: i for i, w in enumerate(listed)}
        total = np.zeros(len(listed) + 1, np.int64)
        for batch in batches:
            for t in batch.column(0):
                own = words_of(text_bytes(t.as_py()))
                total += np.bincount(np.fromiter((at.get(w, len(listed)) for w in own), np.int64, len(own)),
                                     minlength=len(total))
        seen = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["word", "n"])

    sums = columns(docs, text=text_col).mapInArrow(lean(run), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {listed[r["word"]]: r["n"] for r in sums.collect()}  # a row per template word at most


SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
          "base_labels string, labels string, score double")


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licenses named or noticed in every row of ``docs``.

    score is 1 where a phrase stands, else the best containment among matching
    templates, else 0. Null and empty texts have no words and no labels; a null
    id stays null; repeated rows get the same result; an empty table gives no
    rows; a very long text is scanned whole; other columns are not read.
    """
    ship(docs.sparkSession)
    known = frozenset(w for _, t in templates for w in words_of(t.encode()))
    index = Index(templates, word_counts(docs, known, text_col) if templates else {}, threshold)
    named = [(p.encode().split(), index.rank.get(p.split()[0].encode(), 0), label) for p, label in phrases]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.licenses import scan_text

        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        for batch in batches:
            rows = [scan_text(text_bytes(t.as_py()), index, named) for t in batch.column(1)]
            cols = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                names=["doc_id", *names])

    return columns(docs, doc_id=id_col, text=text_col).mapInArrow(lean(run), SCHEMA)
