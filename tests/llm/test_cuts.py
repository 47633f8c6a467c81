"""Fill-in-middle, whitening and decontamination beside brute force and their SQL."""

import hashlib
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import decontaminate, middle, queries, whitening
from tests.llm.fixtures import documents, empty, texts

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_as_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    wanted = db.sql(queries.SQL[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(wanted.columns)
    assert Counter(map(tuple, got.select(*wanted.columns).collect())) == Counter(wanted.fetchall())


# --- fill in middle ---


def brute_middle(doc, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = ["<P>", "a<S", "b<", "<", "\x1f", "\x1e", "\x1eS a\x1fb\x1e\x1f\x1e", "é\x00ß\U0001f600x", "\n\r\n", "x" * 9000, "aé1 " * 30_000, "<<M>"]


def test_middle_beside_brute_force(spark):
    df = documents(spark, texts() + ODD * 3).withColumn("form", F.lit(1)).withColumn("output", F.lit("o"))
    made = middle.fill_in_middle(df, keep=["doc_id", "text", "form"]).toDF("doc_id", "text", "given_form", "n", "form", "prefix_chars", "middle_chars", "output")
    made = made.withColumn("back", middle.restored(F.col("output"), F.col("form")))
    rows = made.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute_middle(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert middle.digests(middle.fill_in_middle(empty(spark))).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert middle.fill_in_middle(empty(spark)).count() == 0


def test_chunks_hold_every_row():
    assert list(middle.chunks([], 5)) == [] and list(middle.chunks([9, 1, 1, 4, 9], 5)) == [(0, 1), (1, 3), (3, 4), (4, 5)]


# --- whitening ---


def vectors(spark, rows, extra="label int"):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], f"vec_id long, embedding array<float>, {extra}").repartition(3)


def brute_whitening(rows):
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=np.int64)
    n, total = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - np.array(total) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    return n, total, x, values[order], axes[:, order]


def test_whitening_beside_brute_force(spark):
    rng = np.random.default_rng(5)
    mixed = rng.standard_normal((400, 20)) @ rng.standard_normal((20, 20))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(mixed)] + [(400 + i, [float(c) for c in mixed[3]]) for i in range(300)]
    bad = [(900, None), (901, [1.0, None] + [0.0] * 18), (902, [float("nan")] * 20), (903, [float("inf")] + [0.0] * 19), (904, []), (905, [1.0, 2.0]), (None, rows[0][1])]
    df = vectors(spark, rows + bad, "deviation int").withColumn("n", F.lit("n")).withColumn("x", F.lit(0))
    n, total, x, values, axes = brute_whitening(rows)
    got = whitening.by_component(whitening.whiten(df)).collect()
    assert Counter(r.vec_id for r in got) == Counter({**{i: 16 for i, _ in rows}, None: 16})
    first = {}
    for r in got:
        if r.vec_id is None:
            continue
        k = r.component - 1
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], total))
        assert abs(r.explained - values[k] / values.sum()) < 1e-12 and r.identity_error < 1e-9
        wanted = (np.array(x[r.vec_id]) - np.array(total) / n) @ axes[:, k] / math.sqrt(values[k])
        sign = first.setdefault(k, 1 if abs(wanted - r.whitened) < abs(wanted + r.whitened) else -1) if abs(wanted) > 1e-3 else first.get(k, 1)
        assert abs(sign * wanted - r.whitened) < 1e-8 or k not in first
    assert len(first) == 16


def test_whitening_of_few_or_flat_vectors(spark):
    assert whitening.by_component(whitening.whiten(vectors(spark, [(1, None), (2, [])]))).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [0.5, 0.25])])).collect()[0].whitened == []
    flat = whitening.by_component(whitening.whiten(vectors(spark, [(i, [float(i), 0.0, 2.0 * i]) for i in range(9)]))).collect()
    assert {r.component for r in flat} == {1} and all(abs(r.explained - 1) < 1e-12 for r in flat)
    huge = whitening.whiten(vectors(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])])).collect()
    assert len(huge) == 3 and any(r.deviation is None for r in huge)


def test_spectrum_is_sliced_exactly():
    rng = np.random.default_rng(1)
    for values in ([5, 5, 5, 2, 1, 1, 0, 0], list(range(30, 0, -1)), [1e6, 1, 1 + 1e-9, 1e-3, 1e-3], [3.0]):
        q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
        matrix = q @ np.diag(values) @ q.T
        matrix = (matrix + matrix.T) / 2
        for shift in (-1.0, 0.5, 2.5, 4.9, 1e7):
            assert whitening.above(matrix, shift) == sum(v > shift for v in values)
        found, axes = whitening.leading(matrix, 4)
        wanted = sorted((v for v in values if v > 0), reverse=True)[:4]
        assert np.allclose(found, wanted, rtol=1e-10, atol=1e-9 * max(values))
        assert np.allclose(axes.T @ axes, np.eye(len(found)), atol=1e-12)
        assert np.allclose(matrix @ axes, axes * found, atol=1e-10 * max(values))


def test_products_are_exact():
    for top in (9, 2**25, 2**40):
        y = np.random.default_rng(2).integers(-top, top, (70, 3))
        assert whitening.exact_products(y) == [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]


# --- decontamination ---

ITEMS = [
    (1, " ".join(f"w{i}" for i in range(14))), (2, "Short One!"), (3, None), (4, ""), (5, " ... "), (None, "no id " * 6), (7, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"),
    (8, "a b " * 20), (9, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (9, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (10, "b a b"), (11, "x" * 500 + " y"), (12, "Éa b-c"),
]
DOCS = [
    "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9", "w1 w2 w3 w4 w5 w6 w7 w8 w9", "Some SHORT, one. then w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 end short one", "no id " * 9, "a b " * 7,
    "b a b", "x" * 500 + " y", "x" * 499 + " y", None, "", "...", "Éa B c; éa b c", "a b " * 20_000, "short two one " * 30, "one short one", "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 " * 3,
]


def norm(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_leaks(items, text):
    words, hit, met = norm(text), set(), set()
    for item, t in items:
        w = norm(t)
        k = min(10, len(w))
        windows = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in windows:
                hit.update(range(i, i + k))
                met.add("" if item is None else str(item))
    return len(words), hit, sorted(met)


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 60])
def test_leaks_beside_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("n", F.lit(1)).repartition(2)
    df = documents(spark, DOCS + DOCS[:3])
    found = decontaminate.find_leaks(df, items, keep=["doc_id", "text", "n"], block_words=block_words)
    rows = found.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
    for r in rows:
        n, hit, met = brute_leaks(ITEMS, r.text)
        assert (r.n_words, r.n_hit, r["items"]) == (n, len(hit), met)
        covered = [i for s in r.spans for i in range(s.start, s.end)]
        assert covered == sorted(hit) and all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
    assert decontaminate.find_leaks(empty(spark), items, block_words=block_words).count() == 0
    none = decontaminate.digests(decontaminate.find_leaks(df, items.limit(0))).collect()
    assert len(none) == df.count() and not any(r.contaminated for r in none)
    assert {r.items_sha256 for r in none} == {hashlib.sha256(b"").hexdigest()}


def test_leaks_are_removed(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    texts = ["Before: " + "other " * 12 + DOCS[0] + ", after.", DOCS[0], "clean  text", None, "a short one here " + "z " * 9]
    found = decontaminate.find_leaks(documents(spark, texts), items, keep=["doc_id", "text"])
    left = {r.doc_id: (r.dropped, r.kept_text) for r in decontaminate.remove(found).collect()}
    assert left[0] == (False, "Before: " + "other " * 12 + ", after.") and left[1] == (True, None)
    assert left[2] == (False, texts[2]) and left[3] == (False, "") and left[4] == (False, texts[4])
    shorter = {r.doc_id: r.kept_text for r in decontaminate.remove(found, min_words=2).collect()}
    assert shorter[4] == "a  here " + "z " * 9


def test_automaton_beside_brute_force():
    rng = np.random.default_rng(3)
    items = [(str(k), [b"%d" % w for w in rng.integers(0, 3, rng.integers(1, 30))]) for k in range(40)]
    automaton = decontaminate.Automaton(items, 5)
    known = {tuple(w[i:j]) for _, w in items for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    words = [b"%d" % w for w in rng.integers(0, 4, 300)]
    for i, (_, length) in enumerate(automaton.walk(map(automaton.vocabulary.get, words)), 1):
        assert length == max((k for k in range(1, 31) if k <= i and tuple(words[i - k : i]) in known), default=0)
