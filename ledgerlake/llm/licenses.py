"""License scan: fixed phrases, and a set-similarity join with templates.

Text blocks (lines, and of a longer line every run of WINDOW words) and license
templates are sets of words.  A block matches a template if it contains at
least THRESHOLD of the template's words.  So does any run of words, over as
many lines as it takes, of at most STRETCH times the template's length: a
notice may be wrapped.  Words are ordered by their number
of occurrences in the whole corpus, rarest first.  A matching block holds one
of the template's first words (prefix filter), has enough words (length
filter), and from the first common place on enough words are left on both
sides (positional filter); what passes is counted exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.textarrays import ALNUM, Words, blocks, word_hash

THRESHOLD = 0.9             # share of a template's words that a block must hold
STRETCH = 2                 # words of a run over lines, in template lengths
WINDOW = 256                # words of a block
# Phrases and their labels
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
TEMPLATES = {
    "mit": ["released under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction"],
    "apache-2": ["Licensed under the Apache License, Version 2.0",
                 "you may not use this file except in compliance with the License. You may obtain a copy of the License at"],
    "cc-by-nc": ["licensed under CC BY-NC 4.0",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "gpl-3": ["This work is licensed under the GNU General Public License, version 3",
              "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
              "Public License as published by the Free Software Foundation, either version 3 of the License"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"],
    "mpl-2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
}


def words_of(text: str) -> list[str]:
    """Words of a text: ASCII letters (lower-cased), digits, non-ASCII."""
    lower = "".join(c.lower() if c.isascii() else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


class Templates:
    """Templates as sets of word ranks, with the filters' numbers."""

    def __init__(self, templates: dict[str, list[str]], count: dict[int, int], threshold: float):
        sets = [(label, {word_hash(w) for w in words_of(t)}) for label, texts in templates.items() for t in texts]
        self.reach = [STRETCH * len(words_of(t)) for texts in templates.values() for t in texts]
        order = sorted(set().union(*(s for _, s in sets)), key=lambda h: (count.get(h, 0), h))
        self.rank = {h: i for i, h in enumerate(order)}
        self.label = [label for label, _ in sets]
        self.words = [sorted(self.rank[h] for h in s) for _, s in sets]
        self.need = [ceil(threshold * len(w) - 1e-9) for w in self.words]
        self.heads: dict[int, list[tuple[int, int]]] = {}       # first words: rank -> (template, position)
        for t, words in enumerate(self.words):
            for place in range(len(words) - self.need[t] + 1):
                self.heads.setdefault(words[place], []).append((t, place))
        self.vocabulary = np.sort(np.array(order, np.uint64))
        ranks = np.array([self.rank[int(h)] for h in self.vocabulary], np.int64)
        self.rank_of = ranks
        self.head_rank = np.zeros(len(order), bool)
        self.head_rank[list(self.heads)] = True
        self.member = np.zeros((len(sets), len(order) + 1), bool)       # by rank; the last (rank -1) is no word
        for t, words in enumerate(self.words):
            self.member[t, words] = True
        self.filter = np.zeros(1 << 16, bool)
        self.filter[self.vocabulary >> np.uint64(48)] = True

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """The rank of each word, -1 for words of no template."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.filter[hashes >> np.uint64(48)])
        at = np.searchsorted(self.vocabulary, hashes[maybe])
        at[at == len(self.vocabulary)] = 0
        same = self.vocabulary[at] == hashes[maybe]
        out[maybe[same]] = self.rank_of[at[same]]
        return out

    def matches(self, block: np.ndarray, size: int) -> dict[int, int]:
        """Templates that a block holds -> number of common words.

        block: distinct ranks of its template words, ascending; size: all its
        distinct words.
        """
        out, tried = {}, set()
        mine = block.tolist()
        for place, word in enumerate(mine):
            for t, at in self.heads.get(word, ()):
                if t in tried or size < self.need[t]:               # length
                    continue
                tried.add(t)
                if min(len(self.words[t]) - at, len(mine) - place) < self.need[t]:      # position
                    continue
                common = len(set(mine).intersection(self.words[t]))
                if common >= self.need[t]:
                    out[t] = common
        return out

    def runs(self, rank: np.ndarray, heads: np.ndarray, begin: int, end: int, least: int = 0) -> dict[int, int]:
        """Templates that a run of words begin..end of one text holds -> the
        greatest number of common words.  A run is as long as the template's
        reach, or ``least`` words if that is more.  Only the places around a
        template's first words are read."""
        out, done = {}, {}
        for at in (np.flatnonzero(heads[begin:end]) + begin).tolist():
            for t, _ in self.heads[int(rank[at])]:
                reach = max(least, self.reach[t])
                a, b = max(begin, at - reach + 1), min(end, at + reach)
                if b <= done.get(t, 0) or b - a < self.need[t]:
                    continue
                places = np.flatnonzero(self.member[t, rank[a:b]])
                if len(places) < self.need[t] or len(np.unique(rank[a:b][places])) < self.need[t]:
                    continue
                done[t] = b
                held: dict[int, int] = {}
                ranks, places = rank[a:b][places].tolist(), places.tolist()
                first = 0
                for place, word in zip(places, ranks, strict=True):
                    held[word] = held.get(word, 0) + 1
                    while place - places[first] >= reach:
                        left = ranks[first]
                        held[left] -= 1
                        if not held[left]:
                            del held[left]
                        first += 1
                    if len(held) >= self.need[t]:
                        out[t] = max(out.get(t, 0), len(held))
        return out


def _vocabulary_counts(rows: DataFrame, templates: dict[str, list[str]]) -> dict[int, int]:
    """Occurrences in the whole corpus of each word of the templates."""
    plain = Templates(templates, {}, 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(plain.vocabulary), np.int64)
        by_rank = np.argsort(plain.rank_of)
        for batch in batches:
            for block in blocks(batch, "text"):
                found = plain.ranks(Words(block.column("text"), ALNUM).hash)
                total[by_rank] += np.bincount(found[found >= 0], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(plain.vocabulary.view(np.int64)), pa.array(total)], ["word", "n"])

    counted = rows.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {r.word % (1 << 64): r.n for r in counted.collect()}     # one row per template word


def _line_blocks(words: Words, begin: int, end: int) -> list[tuple[int, int]]:
    """Word ranges of the lines among words begin..end of one text."""
    newline = np.flatnonzero(words.data[words.start[begin]:words.end[end - 1]] == 10) + words.start[begin]
    cuts = np.unique(np.concatenate([[begin, end], np.searchsorted(words.start[begin:end], newline) + begin])).tolist()
    return list(zip(cuts, cuts[1:], strict=False))


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_base (places of the fixed
    phrases), first_word and last_word (least and greatest start of such a
    place, in words from 0), base_labels, labels (with the templates'; both
    sorted, comma-joined), score (1 with a fixed phrase, else the greatest
    share of a template's words among matching blocks and runs, else 0).

    A null or empty text has no words, no labels and score 0; repeated rows
    are scanned each; equal scores need no tie rule; an empty table gives no
    rows; other columns play no part.
    """
    templates = TEMPLATES if templates is None else templates
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    model = Templates(templates, _vocabulary_counts(rows, templates), threshold)
    phrases = [(np.array([word_hash(w) for w in p.split()], np.uint64), label) for p, label in PHRASES.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                words = Words(block.column("text"), ALNUM)
                n, doc, h = block.num_rows, words.doc_of_word(), words.hash
                base, base_labels = [[] for _ in range(n)], [set() for _ in range(n)]
                for phrase, label in phrases:
                    k = len(phrase)
                    at = np.flatnonzero(h[:max(0, len(h) - k + 1)] == phrase[0])
                    at = at[doc[at] == doc[at + k - 1]]
                    for i in range(1, k):
                        at = at[h[at + i] == phrase[i]]
                    for place in at.tolist():
                        d = int(doc[place])
                        base[d].append(place - int(words.first[d]))
                        base_labels[d].add(label)
                labels, score = [set(s) for s in base_labels], [1.0 if b else 0.0 for b in base]
                rank = model.ranks(h)
                heads = rank >= 0
                heads[heads] = model.head_rank[rank[heads]]
                for d in np.unique(doc[heads]).tolist():
                    begin, end = int(words.first[d]), int(words.first[d + 1])
                    for a, b in _line_blocks(words, begin, end):
                        if not heads[a:b].any():
                            continue
                        if b - a <= WINDOW:
                            mine = np.unique(rank[a:b][rank[a:b] >= 0])
                            held = model.matches(mine, len(np.unique(h[a:b])))
                        else:
                            held = model.runs(rank, heads, a, b, WINDOW)
                        for t, common in held.items():
                            labels[d].add(model.label[t])
                            score[d] = max(score[d], common / len(model.words[t]))
                    for t, common in model.runs(rank, heads, begin, end).items():
                        labels[d].add(model.label[t])
                        score[d] = max(score[d], common / len(model.words[t]))
                joined = [[",".join(sorted(s)) for s in group] for group in (base_labels, labels)]
                yield pa.RecordBatch.from_arrays(
                    [block.column("key"), pa.array(words.per_doc, pa.int64()), pa.array([len(b) for b in base], pa.int64()),
                     pa.array([min(b, default=None) for b in base], pa.int64()), pa.array([max(b, default=None) for b in base], pa.int64()),
                     pa.array(joined[0]), pa.array(joined[1]), pa.array(score)],
                    [key, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    schema = f"`{key}` {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    return rows.mapInArrow(run, schema)
