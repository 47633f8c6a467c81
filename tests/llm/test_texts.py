"""Operators on single texts beside brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from quayside.llm import bpe, licenses, packing, perplexity
from tests.llm.fixtures import documents, empty, texts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def test_bpe_as_the_library(spark):
    ranks = bpe.load_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = documents(spark)
    given = Counter((r.doc_id, r.text) for r in df.collect())
    wanted = Counter()
    for (doc, text), n in given.items():
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        wanted[doc, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()] += n
    got = bpe.encode_documents(df, RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == wanted
    assert all(len(r.ids) == r.n_tokens for r in got)
    assert bpe.encode_documents(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("piece", ["a" * 999, "ab" * 500, "thequickbrown" * 70, "äöü" * 200, "0123456789" * 90, "\n \t" * 300, "'s't" * 50])
def test_bpe_tree_joins_exactly(piece):
    ranks = bpe.load_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    assert list(codec.encode_text(piece)) == library.encode_ordinary(piece)
    assert codec.decode(codec.encode_text(piece)) == piece.encode()


def test_packing_encodes_each_text_whole_in_one_call():
    tokens, library = packing.Tokens(JSON), Tokenizer.from_file(JSON)
    quick, calls = tokens.quick, []

    class Seen:
        def encode_ordinary(self, text):
            calls.append(text)
            return quick.encode_ordinary(text)

    tokens.quick = Seen()
    given = [t or "" for t in texts()] + ["a\x1c b", "it's\u2028 'LL", "x\r\n\t  y ", "\U0001f600é" * 9]
    for text in given:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tokens.encode(text), dtype=tokens.kind).tolist() == ids
    assert calls == [t for t in given if "<|endoftext|>" not in t]


def test_packing_keeps_every_id_once(spark):
    df = documents(spark, [f"word{i} " * (i * 7) for i in range(150)] + [None, "", "it's <|endoftext|> a\x1c"])
    library = Tokenizer.from_file(JSON)
    given = df.collect()
    rows = packing.pack(df, JSON, with_ids=True).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        total = sum(r.length for r in pieces)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        # Full, or a power of two: no padding at all.
        assert total <= 1024 and total & (total - 1) == 0
        assert len({r.step for r in pieces}) == 1 and pieces[0].tier == total
    wanted, got = Counter(), Counter()
    for r in given:
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        wanted.update((r.doc_id, len(ids), i, t) for i, t in enumerate(ids))
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        got.update((r.doc_id, r.doc_tokens, r.start + i, t) for i, t in enumerate(r.ids))
    assert got == wanted
    plain = packing.pack(df, JSON).select("doc_id", "start", "length", "ids_crc32").collect()
    assert sum(r.length for r in plain) == sum(wanted.values())
    assert packing.pack(empty(spark), JSON).count() == 0


def test_plan_prefers_whole_pieces():
    made = packing.plan([600, 424, 512, 100, 28])
    assert (1024, [(0, 0, 600), (1, 0, 424)]) in made
    assert sum(p[2] for _, w in made for p in w) == 1664


def test_license_scan_beside_brute_force(spark):
    lines = ["Licensed under CC BY-NC 4.0.", "the GNU General Public License and all rights reserved. All Rights Reserved", "cc bye", "CC", "x cc\nby y",
             "Released under the mit license, dear reader", " ".join(["filler"] * 300) + " no part of this publication may be reproduced in any form without prior written permission distributed or transmitted"]
    lines += ["licensed under the BSD license", "released under the license of its author", "licensed under the old act, lost the license",
              "licensed under the Apache License, Version 2.0", "GNU Lesser General Public License", "the GNU general license for the public"]
    df = documents(spark, [*lines, None, "", "éCC BY"])
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in licenses.scan_licenses(df).join(df.select("doc_id", "text").distinct(), "doc_id").collect():
        words = word.findall("".join(c.lower() if c.isascii() else c for c in r.text or ""))
        starts, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            parts = phrase.split()
            found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            starts += found
            labels |= {label} if found else set()
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(starts), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        # The similarity join, without its filters: all blocks, all templates, and what another one tells better goes.
        every = set(labels)
        for block in licenses.blocks_of(r.text or ""):
            common = [set(licenses.words_of(t)) & set(block) for *_, t in licenses.TEMPLATES]
            share = [len(c) / len(set(licenses.words_of(t))) for c, (*_, t) in zip(common, licenses.TEMPLATES)]
            names = [" ".join(w.decode() for w in licenses.words_of(name)) for _, name, _ in licenses.TEMPLATES]
            met = {k for k, x in enumerate(share) if x >= 0.8 - 1e-9 and f" {names[k]} ".replace("  ", " ") in f" {' '.join(words)} "}
            label = [t[0] for t in licenses.TEMPLATES]
            for k in met:
                others = [j for j in range(len(label)) if label[j] != label[k] and (j in met or label[j] in labels)]
                value = {j: 1.0 if label[j] in labels else share[j] for j in others}
                if not any(common[k] < common[j] or (common[k] == common[j] and share[k] < value[j]) for j in others):
                    every.add(label[k])
        assert r.labels == ",".join(sorted(every)) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(every)
        if r.text in lines[7:10]:
            assert r.labels == ""
    assert licenses.scan_licenses(empty(spark)).count() == 0


def test_quality_base_rules_and_bands(spark):
    plain = ["Some words of a usual text follow one another here, and there are quite a few different ones in it. " * 1 + f"Number {i} " + " ".join(f"word{i}{j}" for j in range(50)) for i in range(40)]
    noise = " ".join(f"w{i}###" for i in range(80))
    df = documents(spark, [*plain, noise, "a b c " * 40, None, "", "x\nx\n \n \nx", "#$ %"])
    word = re.compile(r"[^\x20\x09-\x0D]+")
    given = {r.doc_id: r.text or "" for r in df.collect()}
    rows = {r.doc_id: r for r in perplexity.quality_rules(df).collect()}
    for doc, text in given.items():
        words, r = word.findall(text), rows[doc]
        lines = text.split("\n")
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        seen = Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
        dup = sum(1 for i, x in enumerate(lines) if word.search(x) and x in lines[:i])
        symbols = sum(c in "#*$%&|<>" for c in text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), symbols, dup, len(repeated))
        assert r.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        assert not (r.base_failed and r.kept)
    assert all(rows[i].kept for i in range(40)) and not rows[40].kept
    assert rows[40].perplexity > rows[40].upper_perplexity
    assert perplexity.quality_rules(empty(spark)).count() == 0


def test_language_model_sums_to_one():
    grams = np.array([(5 << 14) | (6 << 7) | 7, (5 << 14) | (6 << 7) | 8, (6 << 14) | (7 << 7) | 9])
    logs = perplexity.log_probabilities(grams, np.array([5, 1, 2])).reshape(128 * 128, 128)
    assert np.allclose((10.0**logs).sum(1), 1, atol=1e-4)


def test_language_models_of_one_table_beside_the_dense_one(spark):
    rng = np.random.default_rng(6)
    counts = {own: {tuple(int(x) for x in g): int(rng.integers(1, 9)) for g in rng.integers(0, 9, (150, 3)) if g[2]} for own in ("en", "")}
    pack = lambda g, bits: (g[0] << 2 * bits) | (g[1] << bits) | g[2]
    rows = [(own, pack(g, 21), n) for own, found in counts.items() for g, n in found.items()]
    got = {(r.lang, r.gram): r.log_p for r in perplexity.model_of(spark.createDataFrame(rows, "lang string, gram long, n long")).collect()}
    assert len(got) == len(rows)
    for own, found in counts.items():
        grams = sorted(found)
        size = len({g[2] for g in grams})
        logs = perplexity.log_probabilities(np.array([pack(g, 7) for g in grams]), np.array([found[g] for g in grams]), 1 / (size + 1))
        assert all(abs(got[own, pack(g, 21)] - logs[pack(g, 7)]) < 1e-5 for g in grams)


def test_code_points_of_one_remainder_are_told_apart(spark):
    # 31 apart: one symbol of 128 stood for all of them, and a text of others was as likely as its model's own.
    rng = np.random.default_rng(9)
    letters = [chr(0x4E00 + 31 * i) for i in range(8)]
    words = ["".join(rng.choice(letters[:4], 2)) for _ in range(200)]
    text = lambda: " ".join(rng.choice(words) for _ in range(120))
    rows = [(i, text(), "zh") for i in range(60)]
    others = dict(zip(letters[:4], letters[4:]))
    odd = "".join(others[c] if c in others and rng.random() < 0.3 else c for c in text())
    rows += [(900, odd, "zh"), (901, "", "zh"), (902, "\0 \0", "zh")]
    got = {r.doc_id: r for r in perplexity.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[900].perplexity > 1.3 * max(got[i].perplexity for i in range(60)) and not got[900].kept
    assert got[901].perplexity is None and got[902].perplexity > 1


def test_licenses_across_lines_and_side_by_side(spark):
    notice = ["Permission is hereby granted, free of charge, to any person obtaining a copy", "of this software and associated documentation files"]
    cc0 = "to the extent possible under law the author waived all copyright and related or neighboring rights to this work"
    values = [
        "\n".join(notice), "\n".join(["filler"] * 100 + notice + ["filler"] * 200), f"licensed under the MIT license. {cc0}",
        "licensed under CC BY-NC 4.0", "the GNU General Public License", "GNU Affero General\nPublic License", "\n".join([notice[0], "filler " * 130, notice[1]]),
    ]
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(df).collect()}
    assert [got[i][0] for i in range(7)] == ["mit", "mit", "cc0,mit", "cc-by,cc-by-nc", "gpl", "agpl,gpl", ""]
    assert got[0][1] == got[1][1] == 1.0 and got[6][1] == 0.0


def test_license_blocks_leave_out_none():
    rng = np.random.default_rng(5)
    known = [b"a", b"b", b"c", b"d"]
    for _ in range(20):
        words = [known[int(k)] if k < 4 else b"x" for k in rng.integers(0, 60, 400)]
        every = {frozenset(set(b) & set(known)) for b in licenses.blocks_of(" ".join(w.decode() for w in words))}
        found = {frozenset(b) for b in licenses.known_blocks(words, frozenset(known))}
        assert all(any(b <= f for f in found) for b in every if b) and all(any(f <= b for b in every) for f in found)


def test_texts_are_judged_in_the_language_of_their_row(spark):
    rng = np.random.default_rng(8)
    every = [c + v for c in "bcdflmnprst" for v in "aeiou"]
    syllables = {lang: [str(x) for x in rng.choice(every, 14, replace=False)] for lang in ("fr", "es", "en")}

    def text(lang, n=120):
        return " ".join("".join(rng.choice(syllables[lang], rng.integers(2, 5))) for _ in range(n))

    rows = [(i, text(lang), lang) for i, lang in enumerate(["fr", "es", "en"] * 60)]
    rows += [(900, text("fr"), "es"), (901, text("es"), "fr"), (902, text("es"), "en"), (903, " ".join(text(x, 12) for x in ["en", "es", "fr"] * 4), "en")]
    got = {r.doc_id: r for r in perplexity.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(180))
    for i in range(900, 904):
        assert not got[i].base_failed and not got[i].kept, i


def test_orders_of_the_model_are_not_repeated_in_its_plan(spark):
    rows = [("en", 65 << 42 | 66 << 21 | 67 + i, 1 + i) for i in range(9)]
    made = perplexity.model_of(spark.createDataFrame(rows, "lang string, gram long, n long"))
    joins = made._jdf.queryExecution().optimizedPlan().toString().count("Join Inner")
    assert joins <= 5, joins
