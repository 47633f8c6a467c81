"""License scans: an exact set-similarity join of text blocks and notice templates.

A block is any run of BLOCK_WORDS words of a text, across line breaks, or the whole
of a shorter text. A template is found where a block holds at least THRESHOLD of its
distinct words, and the text has the template's name, its distinguishing words one after
the other: the words that short notices share do not tell one licence from another. All that are found count, but one whose words in the block are also
words there of another label that is found and has more of its own, as
notices are alike. A block without a word that the one before lacks adds nothing. Words are ordered by how often they occur in
the whole corpus, counted first; a block is compared with a template only if it
holds one of the template's rarest words (prefix filter), enough words (length
filter) and enough words from the first common one on (positional filter). All
three only leave out pairs that cannot meet the threshold.

Templates are a fixed list, so they and their words' counts travel with the
tasks. A null text counts as empty: no words, no labels, score 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import encode, text_of

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
THRESHOLD = 0.8
BLOCK_WORDS = 128

# The phrases of the base rules and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices as their licences print them: label, name (none where the notice itself is unlike any other), notice.
TEMPLATES = (
    ("mit", "MIT license", "released under the MIT license"),
    ("mit", "MIT license", "licensed under the MIT license"),
    ("mit", "", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Apache License", "licensed under the Apache License, Version 2.0"),
    ("gpl", "GNU General Public License", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "GNU General Public License", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "Lesser General Public License", "GNU Lesser General Public License"),
    ("agpl", "Affero General Public License", "GNU Affero General Public License"),
    ("mpl-2.0", "Mozilla Public License", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("bsd", "", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "CC BY-NC", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "CC BY-SA", "licensed under CC BY-SA 4.0"),
    ("cc-by-nd", "CC BY-ND", "licensed under CC BY-ND 4.0"),
    ("cc0", "", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("reserved", "all rights reserved", "all rights reserved"),
    ("no-copying", "", "no part of this publication may be reproduced, distributed, or transmitted in any form without prior written permission"),
)


def words_of(text: str) -> list[bytes]:
    """Words with A-Z in lower case; other letters stay as they are."""
    return WORD.findall(encode(text).lower())


def count_words(df: DataFrame, wanted: frozenset[bytes], text: str = "text") -> dict[bytes, int]:
    """How often each of the ``wanted`` words occurs in all texts; at most one row per wanted word."""

    def count(frames):
        total: Counter = Counter()
        for frame in frames:
            for value in frame.iloc[:, 0]:
                total.update(filter(wanted.__contains__, words_of(text_of(value))))
        if total:
            yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    counted = df.select(F.col(text).alias("t")).mapInPandas(count, "word binary, n long")
    return {bytes(r.word): r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


class Templates:
    """The templates' distinct words, rarest first, and the index of their prefixes."""

    def __init__(self, counts: dict[bytes, int], templates, threshold: float):
        every = {w for *_, t in templates for w in words_of(t)}
        self.order = {w: i for i, w in enumerate(sorted(every, key=lambda w: (counts.get(w, 0), w)))}
        self.sets = []
        self.index: dict[bytes, list[tuple[int, int]]] = {}
        self.names = [tuple(words_of(name)) for _, name, _ in templates]
        for k, (label, _, text) in enumerate(templates):
            ordered = sorted(set(words_of(text)), key=self.order.__getitem__)
            need = math.ceil(threshold * len(ordered) - 1e-9)
            self.sets.append((label, frozenset(ordered), need))
            for i in range(len(ordered) - need + 1):
                self.index.setdefault(ordered[i], []).append((k, i))

    def named(self, words: list[bytes]) -> frozenset[int]:
        """Templates whose name the words have, and those without one."""
        held, found = set(words), {(): True}
        for name in set(self.names) - {()}:
            found[name] = held.issuperset(name) and any(
                w == name[0] and tuple(words[i : i + len(name)]) == name for i, w in enumerate(words)
            )
        return frozenset(k for k, name in enumerate(self.names) if found[name])

    def join(self, block: set[bytes], named: frozenset[int], base: set[str] = frozenset()) -> list[tuple[str, float]]:
        """(label, containment) of every template of ``named`` that the block meets, but for those that tell less than another.

        ``base``: labels that the text has by their exact phrases.
        """
        met: dict[int, frozenset[bytes]] = {}
        known = sorted(block & self.order.keys(), key=self.order.__getitem__)
        tried = set()
        for j, word in enumerate(known):
            for k, i in self.index.get(word, ()):
                _, wanted, need = self.sets[k]
                if k in tried or k not in named or len(known) < need:
                    continue
                tried.add(k)
                # Words before the first common one are in one of the two only.
                if 1 + min(len(wanted) - i - 1, len(known) - j - 1) < need:
                    continue
                common = wanted.intersection(known)
                if len(common) >= need:
                    met[k] = common
        share = {k: len(common) / len(self.sets[k][1]) for k, common in met.items()}

        def tells_less(k: int) -> bool:
            for j, (label, wanted, _) in enumerate(self.sets):
                if label != self.sets[k][0] and (j in met or label in base):
                    other = wanted.intersection(known)
                    if met[k] < other or (met[k] == other and share[k] < (1.0 if label in base else share[j])):
                        return True
            return False

        return [(self.sets[k][0], share[k]) for k in met if not tells_less(k)]


def blocks_of(text: str):
    """Every run of BLOCK_WORDS words, or all words of a shorter text."""
    words = words_of(text)
    for a in range(max(1, len(words) - BLOCK_WORDS + 1)):
        if words:
            yield words[a : a + BLOCK_WORDS]


def known_blocks(words: list[bytes], known):
    """The ``known`` words of every block that has one more than the block before."""
    places = [(i, w) for i, w in enumerate(words) if w in known]
    held: Counter = Counter()
    end, more = 0, False
    for i, word in places:
        while end < len(places) and places[end][0] < i + BLOCK_WORDS:
            more = more or not held[places[end][1]]
            held[places[end][1]] += 1
            end += 1
        if more:
            yield {w for w, n in held.items() if n}
            more = False
        held[word] -= 1


def scan_text(text: str, templates: Templates, phrases: dict[tuple[bytes, ...], str]):
    """(words, phrase starts, base labels, labels, score) of one text."""
    words = words_of(text)
    held = set(words)
    starts, base = [], set()
    for phrase, label in phrases.items():
        if held.issuperset(phrase):
            first, n = phrase[0], len(phrase)
            found = [i for i, w in enumerate(words) if w == first and tuple(words[i : i + n]) == phrase]
            starts += found
            base |= {label} if found else set()
    labels, score = set(base), 1.0 if base else 0.0
    if not templates.index.keys().isdisjoint(held):
        named = templates.named(words)
        for block in known_blocks(words, templates.order):
            if not templates.index.keys().isdisjoint(block):
                for label, share in templates.join(block, named, base):
                    labels.add(label)
                    score = max(score, share)
    return len(words), starts, base, labels, score


def scan_licenses(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """Per document: words, places of base phrases, base labels, all labels and the best containment."""
    given = df.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    wanted = frozenset(w for *_, t in templates for w in words_of(t))
    counts = count_words(given, wanted)
    phrases = {tuple(words_of(p)): label for p, label in PHRASES.items()}

    def run(frames):
        known = Templates(counts, templates, threshold)
        for frame in frames:
            rows = []
            for doc, value in zip(frame["doc_id"], frame["text"]):
                n, starts, base, labels, score = scan_text(text_of(value), known, phrases)
                ends = (min(starts), max(starts)) if starts else (None, None)
                rows.append((doc, n, len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score))
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    schema = "doc_id string, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return given.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast(df.schema[doc_id].dataType))
