"""Operators that need the whole corpus, beside brute force on a small one."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import minhash, perplexity, suffix_dedup, suffix_tree, syncmers, toxicity, wrappers
from quayside.llm.components import components
from tests.llm.fixtures import documents, empty, texts


def brute_repeats(values, length):
    data = [(t or "").encode() for t in values]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone) if not y)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length, key, hot", [(400, 100, 4096), (120, 30, 4096), (120, 30, 1)])
def test_repeats_beside_brute_force(spark, monkeypatch, length, key, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    df = documents(spark)
    given = df.select("doc_id", "text").collect()
    wanted = Counter((r.doc_id, *b) for r, b in zip(given, brute_repeats([r.text for r in given], length)))
    got = suffix_dedup.remove_repeats(df, length=length, key=key).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == wanted
    assert sum(r.n_removed for r in got) > 0


def test_repeats_of_no_documents(spark):
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_loser_tree_merges_and_knows_prefixes():
    rng = np.random.default_rng(1)
    every = [bytes(rng.integers(97, 99, rng.integers(0, 30)).astype(np.uint8)) for _ in range(300)]
    runs = [sorted((s, b"", i) for s in every[i::7]) for i in range(7)]
    coded = [suffix_dedup.decode_run(*suffix_dedup.front_code(r)) for r in runs]
    out = list(suffix_dedup.LoserTree(coded))
    assert [o[1] for o in out] == sorted(every)
    for (_, a, _, _), (h, b, _, _) in zip(out, out[1:]):
        assert h == suffix_dedup.common_prefix(a, b, 0)


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (4, 9), (9, 8), (7, 7), (3, 2)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 8: 4, 9: 4}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_links(given):
    word = re.compile(r"[^\x20\x09-\x0d]+")

    def shingles(text):
        words = word.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets = [shingles(t) for _, t in given]
    links, root = [0] * len(given), list(range(len(given)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if a == b or (both and both * 10 >= 8 * (len(a) + len(b) - both)):
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    return links, [find(i) for i in range(len(given))]


@pytest.mark.parametrize(("tile", "refine"), [(1024, 64), (4, 64), (1024, 1), (4, 2)])
def test_near_duplicates_beside_brute_force(spark, monkeypatch, tile, refine):
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "REFINE", refine)
    base = texts()[7].split(" ") + texts()[8].split(" ")
    copies = [" ".join(base[:i] + ["new"] + base[i + 1 :]) for i in range(0, 60, 4)] + [" ".join(base + ["more"] * i) for i in range(9)]
    df = documents(spark, texts() + copies)
    given = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    links, roots = brute_links(given)
    least = {}
    for (doc, _), root in zip(given, roots):
        if doc is not None:
            least[root] = min(doc, least.get(root, doc))
    wanted = Counter((doc, least.get(root), n) for (doc, _), root, n in zip(given, roots, links))
    got = minhash.near_duplicates(df).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == wanted
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_boilerplate_does_not_gather_the_corpus(spark, monkeypatch):
    met = []
    placed = minhash._placed

    def seen(members, threshold):
        met.extend(r.key for r in members.collect())
        return placed(members, threshold)

    monkeypatch.setattr(minhash, "_placed", seen)
    rng = random.Random(5)
    notice = " ".join(f"n{i}" for i in range(100))
    values = [notice + " " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(60)) for _ in range(300)]
    values += [v + " more" for v in values[:5]]
    got = minhash.near_duplicates(documents(spark, values)).where("doc_id IS NOT NULL").collect()
    assert {r.doc_id: r.n_links for r in got if r.n_links and r.doc_id > 0} == dict.fromkeys([1, 2, 3, 4, 300, 301, 302, 303, 304], 1) | {300: 2}
    assert len(met) == 10


def test_bands_meet_the_recall():
    bands, rows = minhash.choose_bands(0.8, 128, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 128


def test_syncmers_beside_brute_force(spark):
    df = documents(spark)
    given = sorted(((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect() if r.doc_id is not None), key=lambda x: (-x[0], x[1]))
    given.append((None, "a text without an id"))
    rows = {}
    for r in syncmers.fingerprint_documents(df).collect():
        rows.setdefault(r.doc_id, r)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    for i, (doc, text) in enumerate(given):
        follower = given[(i + 1) % len(given)][1]
        k = len(text) // 3
        changed = text[: len(text) - k] + follower[:k]
        assert rows[doc].n_chars == len(text)
        if doc != 0:  # id 0 is there twice: either may follow the other
            assert rows[doc].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        same = spark.createDataFrame([(1, text), (2, changed)], "doc_id long, text string") if i % 40 == 0 else None
        if same is not None:
            two = {r.doc_id: r for r in syncmers.fingerprint_documents(same).collect()}
            assert two[1].fingerprint == rows[doc].fingerprint and (doc == 0 or two[2].fingerprint == rows[doc].edited_fingerprint)
    assert syncmers.fingerprint_documents(empty(spark)).count() == 0


def brute_likeness(one, two):
    one, two = ({k: int(v, 16) for k, _, v in (a.partition(":") for a in x.split())} for x in (one, two))
    if not one and not two:
        return 1.0
    shared = sorted(one.keys() & two.keys(), key=one.get)
    ranks = [sorted(map(two.get, shared)).index(two[k]) for k in shared]
    moved, n = sum(abs(i - r) for i, r in enumerate(ranks)), len(shared)
    return n / len(one.keys() | two.keys()) * (1 - (moved / (n * n // 2) if n > 1 else 0) / 2)


def test_likeness_beside_brute_force(spark):
    rng = random.Random(11)
    parts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(8)]
    long = [" ".join(f"v{rng.randrange(10**9)}" for _ in range(20_000)) for _ in range(2)]
    values = ["\n".join(parts), "\n".join(rng.sample(parts, 8)), "\n".join(parts[4:] + parts[:4]), "\n".join(parts)]
    values += [long[0] + "\n" + parts[0], parts[0] + "\n" + long[1], *texts(rows=20)]
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    got = {r.doc_id: r for r in syncmers.fingerprint_documents(df).collect()}
    for i, r in got.items():
        follower = got[(i - 1) % len(values)]
        assert math.isclose(r.near_edited, brute_likeness(r.fingerprint, r.edited_fingerprint))
        assert math.isclose(r.near_next, brute_likeness(r.fingerprint, follower.fingerprint))
    assert got[0].fingerprint == got[3].fingerprint and 0 < got[1].near_next < 0.6 and 0.3 < got[3].near_next < 0.6
    assert 0 < got[5].near_next < 0.01


def test_syncmers_are_context_free_and_native(spark):
    passage = " ".join(f"w{i * i % 97}" for i in range(60))
    df = spark.createDataFrame([(1, passage), (2, "other words first " + passage + " and after")], "doc_id long, text string")
    anchors = {}
    for r in syncmers.document_anchors(df).collect():
        anchors.setdefault(r.doc_id, set()).add((r.hash, r.place))
    assert {(h, p + 3) for h, p in anchors[1]} <= anchors[2] and len(anchors[1]) > 10
    plan = syncmers.fingerprint_documents(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_order_of_rows_crosses_neighbourhoods(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "NEIGHBOURS", 4)
    rows = [(i // 9 if i < 30 else i, f"text {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.text: r.next.text for r in syncmers.with_next(df, ["text"]).collect()}
    ids = {t: i for i, t in rows}
    assert len(got) == 60 and sorted(got.values()) == sorted(got)
    at, seen = max(got, key=lambda t: ids[t]), []
    for _ in range(60):
        seen.append(ids[at])
        at = got[at]
    assert seen == sorted(seen, reverse=True)


def test_suffix_tree_beside_brute_force(spark):
    line = "here the same words always follow one another"
    df = documents(spark, texts() + [f"{line} {t}" for t in texts()[:60]])
    given = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    tokens = [(d, suffix_tree.words_of(t) + [b""]) for d, t in given]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in tokens]
    counts = Counter(w for (d, ws), h in zip(tokens, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    rows = {r.doc_id: r for r in suffix_tree.score_documents(df).collect()}
    better = 0.0
    for (doc, words), out in zip(tokens, held):
        r = rows[doc]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, len(words), sum(w in counts for w in words), n)
        assert abs(r.base_score - base) < 1e-6 and r.score <= 0
        better += (r.score - base) * out
    assert better > 0
    assert suffix_tree.score_documents(empty(spark)).count() == 0


def test_large_ids_beside_a_null_stay_exact(spark):
    df = spark.createDataFrame([(2**60 + 1, "a b", "en"), (None, "c d", None), (2**60 + 2, "e", "en")], "doc_id long, text string, lang string")
    wanted = {2**60 + 1, 2**60 + 2, None}
    for made in (
        suffix_dedup.remove_repeats(df), minhash.near_duplicates(df), suffix_tree.score_documents(df),
        perplexity.quality_rules(df), toxicity.score_toxicity(df, df.selectExpr("doc_id", "1 AS toxic")),
    ):
        assert {r.doc_id for r in made.select("doc_id").collect()} == wanted


def test_suffix_tree_states_sum_to_one():
    import pandas as pd

    tree = suffix_tree.Tree([b"", b"a", b"b"])
    counted = pd.DataFrame({"code": [1 * 4 + 2, 2 * 4 + 1], "n": [90, 40], "kinds": [2, 3]})
    root = np.array([0.2, 0.4, 0.3, 0.1])
    tree.add_level(counted, root[[2, 1]], np.array([0.0, 100.0, 50.0]), 2.0)
    kept = tree.levels[0][0]
    assert kept[1] and kept[2]
    for u in (1, 2):
        sums = 0.0
        for w in (0, 1, 2, -1):
            line = np.array([0, u, w])
            sums += tree.chances(line, np.array([0]), root[line])[2]
        assert abs(sums - 1) < 1e-9


def brute_force_tree(tokens, held):
    """log10 p of each text by a suffix tree in dictionaries: all contexts and next words seen twice, tested level by level."""
    train = [[b"", *ws] for ws, h in zip(tokens, held) if not h]
    counts = Counter(w for line in train for w in line[1:])
    n, v = sum(counts.values()), len(counts)
    ones, twos = (sum(c == k for c in counts.values()) for k in (1, 2))
    discount = min(0.95, max(0.05, ones / (ones + 2 * twos)))
    tree, grams = {}, {(w,): c for w, c in counts.items() if c > 1}

    def chance(line, i, depth):
        p = (counts[line[i]] - discount) / n if line[i] in counts else discount * v / n
        for k in range(1, min(depth, i) + 1):
            total, kinds, shown = tree.get(tuple(line[i - k : i]), (0, 0, {}))
            if total:
                p = (shown.get(line[i], 0) + (total - sum(shown.values()) + kinds) * p) / (total + kinds)
        return p

    for k in (1, 2, 3):
        follow = {}
        for line in train:
            for i in range(k, len(line)):
                if tuple(line[i - k : i]) in grams:
                    word = line[i] if counts[line[i]] > 1 else None
                    follow.setdefault(tuple(line[i - k : i]), Counter())[word] += 1
        grams, new = {}, {}
        for h, words in follow.items():
            total, kinds = sum(words.values()), len(words)
            shown = {w: c for w, c in words.items() if w is not None and c > 1}
            grams |= {(*h, w): c for w, c in shown.items()}
            back = (total - sum(shown.values()) + kinds) / (total + kinds)
            gain = (total - sum(shown.values())) * math.log(back)
            for w, c in shown.items():
                p = chance([*h, w], k, k - 1)
                gain += c * math.log((c / (total + kinds) + back * p) / p)
            if gain > suffix_tree.DIVERGENCE * max(1, len(shown)):
                new[h] = (total, kinds, shown)
        tree |= new
    return [sum(math.log10(chance([b"", *ws], i, 3)) for i in range(1, len(ws) + 1)) for ws in tokens]


def test_suffix_tree_as_joins_is_that_in_dictionaries(spark, monkeypatch):
    rng = np.random.default_rng(2)
    words = np.array([f"w{i}" for i in range(60)])
    values = [" ".join(words[np.minimum(rng.zipf(1.3, 40) - 1, 59)]) for _ in range(120)]
    values += [f"{values[i]} Once{i} of a kind\tand again" for i in range(30)] + [None, "", " \n", "é É"]
    df = documents(spark, values)
    rows = df.select("doc_id", "text").collect()
    held = [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    scores = brute_force_tree([suffix_tree.words_of(r.text or "") + [b""] for r in rows], held)
    wanted = {r.doc_id: s for r, s in zip(rows, scores)}
    monkeypatch.setattr(suffix_tree, "WINDOW", 16)
    # No heavy context, some, and only such.
    for most in (1, 200, 1 << 40):
        monkeypatch.setattr(suffix_tree, "HEAVY", most)
        got = {r.doc_id: r.score for r in suffix_tree.score_documents(df).collect()}
        assert all(abs(got[d] - p) < 1e-6 * abs(p) for d, p in wanted.items()), most


def test_suffix_tree_splits_words_as_the_base_does():
    odd = ["", " ", "  a\tB  c\n", "x\x0by\x0cz\r", "a\x00 a \x1c\x1f", "É\xa0é\u2003w \x85", "\x7f\x08 \x0e", "😀 A-Z [\\]^_` aZ", "b" * 3000, "end "]
    for values in (odd, [""], odd[2:4] * 700):
        data = [v.encode() for v in values]
        words = suffix_tree.Texts(pa.array([str(i) for i in range(len(data))]), pa.array([len(d) for d in data], pa.int64()), b"".join(data))
        found = [*(w.encode() for w in words.dictionary.to_pylist()), b""]
        wanted = [w for v in values for w in [*suffix_tree.words_of(v), b""]]
        assert [found[c] for c in words.code] == wanted
        assert words.sizes.tolist() == [len(suffix_tree.words_of(v)) + 1 for v in values]
        assert len(set(words.words.tolist())) == len(found)


def test_suffix_tree_reads_texts_for_its_words_only(spark, tmp_path):
    documents(spark, texts()).write.parquet(f"{tmp_path}/documents")
    scored = suffix_tree.score_documents(spark.read.parquet(f"{tmp_path}/documents"))
    # The tree's passes read windows by the numbers of their words.
    assert scored.inputFiles() and not [f for f in scored.inputFiles() if str(tmp_path) in f]


def test_suffix_tree_sends_n_grams_in_few_bytes():
    rng = np.random.default_rng(8)
    words = np.array([f"w{i}" for i in range(60_000)])
    values = [" ".join(words[rng.zipf(1.2, 200) % 60_000]).encode() for _ in range(2000)]
    ids, sizes = pa.array([str(i) for i in range(2000)]), pa.array([len(v) for v in values], pa.int64())
    window, buckets = suffix_tree.Texts(ids, sizes, b"".join(values)), 16
    asked = window.word_rows(0, buckets)
    answers = pa.concat_tables(suffix_tree.count_words(asked.slice(i, 1)) for i in range(asked.num_rows))
    at = suffix_tree.Asked(window.coded(0, answers, buckets), lambda counts: (counts + 1.0) / 500_000)
    at.ask(1, buckets, 5000)
    rows = at.gram_rows(0, buckets)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(rows)
    # With whole hashes of contexts, 48 bits of a next word and 32 of a count these were 10.4 bytes each.
    assert len(at.grams) > 100_000 and sink.getvalue().size < 7 * len(at.grams)
    # Compressed, the numbers of the words need less than the texts.
    coded = window.coded(0, answers, buckets)
    size = sum(len(coded[c][0].as_py()) for c in ("codes", "numbers", "counts"))
    assert size < len(pa.compress(b"".join(values), codec="zstd", asbytes=True))


def test_suffix_tree_learns_what_is_rare_in_a_large_corpus(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(20_000)])
    values = [" ".join(words[rng.integers(0, 20_000, 1000)]) for _ in range(1300)]
    phrase = "an uncommon phrase occurs four times"
    train = [i for i in range(1300) if zlib.crc32(str(i).encode()) % 7 != 2][:4]
    for i in train:
        values[i] += f" {phrase}"
    held = next(i for i in range(1300, 1400) if zlib.crc32(str(i).encode()) % 7 == 2)
    df = spark.createDataFrame([*enumerate(values), (held, phrase)], "doc_id long, text string")
    row = suffix_tree.score_documents(df).where(f"doc_id = {held}").first()
    assert row.n_known == row.n_tokens == 7
    # Five of its words follow others by which they are known almost surely.
    assert row.score > row.base_score + 15


def test_toxicity_holds_out_and_learns(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]

    def text(bad):
        found = list(rng.choice(words, 60))
        for w in bad:
            found.insert(int(rng.integers(0, 60)), w)
        return " ".join(found)

    values = [text(list(rng.choice(["vile", "rotten", "foul"], 3)) if i % 5 == 0 else []) for i in range(400)]
    df = documents(spark, [*values, None, ""])
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(7, None), (None, 1)], "doc_id long, toxic int")
    rows = {r.doc_id: r for r in toxicity.score_toxicity(df, labels).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(rows[i].held_out == (i in held) for i in range(400))
    assert all(rows[i].predicted == int(i % 5 == 0) for i in held)
    assert rows[401].predicted == 0 and rows[None].predicted == 0
    # Held-out labels are not read.
    turned = labels.replace({0: 1, 1: 0}, subset=["toxic"]).where(labels.doc_id.isin(held)).union(labels.where(~labels.doc_id.isin(held)))
    again = {r.doc_id: r.score for r in toxicity.score_toxicity(df, turned).collect()}
    assert all(abs(again[i] - rows[i].score) < 1e-9 for i in range(400))
    nothing = toxicity.score_toxicity(df, labels.where("toxic = 0")).collect()
    assert {r.score for r in nothing} == {0.0}
    assert toxicity.score_toxicity(empty(spark), labels).count() == 0


def test_label_model_shares_evidence_of_equal_voters():
    rng = np.random.default_rng(0)
    truth = rng.random(800) < 0.3
    good = truth ^ (rng.random(800) < 0.05)
    weak = truth ^ (rng.random(800) < 0.4)
    votes = np.column_stack([good, *[weak] * 10]).astype(float)
    labels = truth ^ (rng.random(800) < 0.1)
    found = toxicity.label_model(votes, labels.astype(float)) > 0.5
    assert (found == truth).mean() > 0.9


PAGE = """<html><body class="news"><div class="menu"><a href=/>Home</a></div><div class="story"><h1>A &amp; b</h1><p>First   part<br>second {i}
<p>third <b>bold</b> text of a certain length {i}<form>name</form><div class="comments">no</div></div><div class="sidebar">s</div><footer>f</footer>"""


def test_pages(spark):
    pages = [(i, "http://a.example/x", PAGE.replace("{i}", str(i))) for i in range(90)]
    odd = [(100, None, None), (101, "b", ""), (102, "http://a.example/y", "plain &lt;text"), (None, "http://c.example", "<article><script>x</script>T</article><nav>n</nav>"),
           (103, "http://a.example/z", "<p>unclosed <b>tag <i class='x"), (104, "http://a.example", "<main><ul>" + "<li>i</li>" * 50 + "</ul></main>")]
    df = spark.createDataFrame(pages + odd, "page_id long, url string, html string")
    rows = {r.page_id: r for r in wrappers.extract(df).collect()}
    assert len(rows) == 96
    for i in range(90):
        assert rows[i].text == f"A & b\nFirst part\nsecond {i}\nthird bold text of a certain length {i}"
        assert rows[i].n_chars == len(rows[i].text)
    assert [rows[k].text for k in (100, 101, 102, None)] == ["", "", "plain <text", "T"]
    assert rows[103].text.startswith("unclosed") and rows[104].text == "\n".join(["i"] * 50)
    assert wrappers.extract(df.limit(0)).count() == 0


def test_wrappers_find_optional_and_repeated_groups():
    one = wrappers.fold(wrappers.Page("<body><ul><li>a<li>b</ul><p>x</p><p>y</p></body>").stream)
    two = wrappers.fold(wrappers.Page("<body><p>x</p><table><tr><td>1</td></tr></table></body>").stream)
    assert wrappers.shown(wrappers.align(one, two)) == "<body>(<ul>(<li>#</li>)+</ul>)?(<p>#</p>)+(<table><tr><td>#</td></tr></table>)?</body>"


def test_wrappers_decide_which_blocks_stay(spark):
    notice = "<div class=x><p>This site is kept by volunteers.</p></div>"
    body = "<div class=post><h1>Title {i}</h1><p>A lead of some length {i}.</p><div class=body>{long}</div><p>An end {i}.</p></div>"
    made = []
    for i in range(12):
        page = f"<body>{notice}" + body.replace("{i}", str(i)).replace("{long}", f"<p>word{i} and many more of them</p>" * (9 + i))
        made.append((i, f"http://h.example/{i}", page + ("<div><p>only here</p></div>" if i % 3 == 0 else "") + notice))
    made += [(20 + i, "http://g.example", f"<article><p>one {i}</p></article><div>beside</div><article>two {i}</article>") for i in range(4)]
    # Copies of one page tell nothing of their host.
    made += [(30 + i, "http://f.example", "<div>same</div><div>text</div>") for i in range(5)]
    rows = {r.page_id: r.text.split("\n") for r in wrappers.extract(spark.createDataFrame(made, "page_id long, url string, html string")).collect()}
    for i in range(12):
        wanted = [f"Title {i}", f"A lead of some length {i}.", *[f"word{i} and many more of them"] * (9 + i), f"An end {i}."]
        assert rows[i] == wanted + ["only here"] * (i % 3 == 0)
    assert all(rows[20 + i] == [f"one {i}", f"two {i}"] for i in range(4))
    assert all(rows[30 + i] == ["same", "text"] for i in range(5))


def test_wrappers_match_the_pages_they_come_from():
    pages = ["<body><ul><li>a<li>b</ul><p>x</p><p>y</p></body>", "<body><p>x</p><table><tr><td>1</td></tr></table></body>", "<body><p>z</p></body>"]
    streams = [wrappers.Page(p).stream for p in pages]
    whole = wrappers.fold(streams[0])
    for stream in streams[1:]:
        whole = wrappers.align(whole, wrappers.fold(stream))
    matcher = wrappers.Matcher(whole)
    for stream in streams:
        path = matcher.match(stream)
        assert path and [matcher.items[i] for i in path] == stream
    assert matcher.match(["table", "#"]) is None


def test_wrappers_match_pages_of_any_shape():
    rng = np.random.default_rng(1)
    for _ in range(80):
        pages = []
        for _ in range(4):
            tags = rng.choice(["p", "div", "blockquote", "li"], 30)
            pages.append("<body>" + "".join(f"<{t}>{'' if k % 3 else 'x'}</{t}>" for k, t in enumerate(tags)) + "</body>")
        streams = [wrappers.Page(p).stream for p in pages]
        whole = wrappers.fold(streams[0])
        for stream in streams[1:]:
            whole = wrappers.align(whole, wrappers.fold(stream))
        matcher = wrappers.Matcher(whole)
        for stream in streams:
            path = matcher.match(stream)
            assert path and [matcher.items[i] for i in path] == stream


def test_components_that_are_stars_need_no_round(spark, monkeypatch):
    from quayside.llm import components as module

    monkeypatch.setattr(module, "_large_star", None)
    edges = [(3, 1), (2, 1), (9, 4), (9, 4), (7, 7)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (9, 4)}
    for edges in ([(1, 3)], [(3, 1), (3, 2)], [(3, 2), (2, 1)]):
        assert not module._all_stars(spark.createDataFrame(edges, "a long, b long"))


def test_wrappers_with_many_optional_parts_match_too(monkeypatch):
    parts = [[f"div.{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", "#", "/div"] for i in range(3000)]
    whole = ["body", *[["?", p] for p in parts], "/body"]
    matcher = wrappers._matchers()("h", json.dumps(whole))
    stream = ["body", *[x for p in parts[::3] for x in p], "/body"]
    for held in (wrappers.HELD_STATES, 1):
        monkeypatch.setattr(wrappers, "HELD_STATES", held)
        path = matcher.match(stream)
        assert path and [matcher.items[i] for i in path] == stream and path == sorted(path)
    assert matcher.match(["body", *parts[5], *parts[4], "/body"]) is None


def test_pages_without_article_keep_what_is_beside_the_body(spark):
    body = "<p>The body is much longer than its title. </p>" * 20
    made = [(i, f"http://{i}.example", f"<div class=post><h1>Title</h1><p>Lead</p><div class=body>{body}</div><ul><li>end</ul></div>") for i in range(2)]
    made += [(2, "http://2.example", "<article>one</article><article>two</article>")]
    rows = {r.page_id: r.text.split("\n") for r in wrappers.extract(spark.createDataFrame(made, "page_id long, url string, html string")).collect()}
    assert [rows[0][0], rows[0][1], rows[0][-1]] == ["Title", "Lead", "end"] and len(rows[0]) == 23
    assert rows[1] == rows[0] and rows[2] == ["one", "two"]


def page_texts(spark, made):
    df = spark.createDataFrame(made, "page_id long, url string, html string").withColumns({"host": F.lit("h"), "text": F.lit("t"), "wrapper": F.lit(1)})
    return {r.page_id: r.text.split("\n") for r in wrappers.extract(df).collect()}


def test_layout_classes_do_not_take_the_article_out(spark):
    story = "<h1>Title</h1><p>A long story of many words, told once.</p><p>Its end.</p>"
    lines = ["Title", "A long story of many words, told once.", "Its end."]
    shapes = [
        f'<div class="content with-sidebar">{story}</div>',
        f'<div id=post class="post has-comments">{story}</div>',
        f'<article><h1>Title</h1><section class="share-prices"><p>A long story of many words, told once.</p></section><p>Its end.</p></article>',
        f'<div class="notice">{story}</div><div class="ad">Buy.</div>',
        f'<article>{story}</article><div class="ad">{"Buy this. " * 40}</div><div class="comment-list">{"I agree. " * 40}</div>',
        f'<div>{story}</div><div class="comments">{"I agree. " * 40}</div><div class="sidebar-box">More</div>',
    ]
    got = page_texts(spark, [(i, f"http://{i}.example", f"<body>{s}</body>") for i, s in enumerate(shapes)])
    assert all(got[i] == lines for i in range(len(shapes)))


def test_a_teaser_does_not_replace_the_story(spark):
    page = '<body><div class=lead>A lead {i}</div><article class=teaser>Teaser {i}</article><div id="story"><p>A story {i}</p><p>that goes on {i}</p></div></body>'
    got = page_texts(spark, [(i, "http://a.example", page.replace("{i}", str(i))) for i in range(3)])
    assert all(got[i] == [f"A lead {i}", f"Teaser {i}", f"A story {i}", f"that goes on {i}"] for i in range(3))


def test_without_wrappers_the_notices_of_a_host_stay(spark, monkeypatch):
    made = [(i, "http://a.example", f"<body><div class=q><p>Kept by volunteers.</p></div><div><p>Story {i}</p><p>goes on {i}</p></div></body>") for i in range(6)]
    assert page_texts(spark, made) == {i: [f"Story {i}", f"goes on {i}"] for i in range(6)}
    monkeypatch.setattr(wrappers, "TEMPLATE_PAGES", 100)
    assert page_texts(spark, made) == {i: ["Kept by volunteers.", f"Story {i}", f"goes on {i}"] for i in range(6)}


def test_pages_of_fifty_thousand_tags(spark):
    rng = np.random.default_rng(4)
    made = []
    for i in range(3):
        tags = rng.choice(["p", "div", "blockquote", "li"], 25_000)
        body = "".join(f"<{t}>{'' if k % 7 else f'text {k} of {i}'}</{t}>" for k, t in enumerate(tags))
        made.append((i, "http://a.example", f"<body><section>Same on all</section>{body}</body>"))
    got = page_texts(spark, made)
    assert all(got[i] == [f"text {k} of {i}" for k in range(0, 25_000, 7)] for i in range(3))


def test_common_items_beside_the_full_table(monkeypatch):
    rng = np.random.default_rng(6)
    for bits in (1, 8, 64, 1 << 28):
        monkeypatch.setattr(wrappers, "ALIGN_BITS", bits)
        for _ in range(60):
            one, two = (list(rng.choice(list("abcd"), rng.integers(0, 15))) for _ in range(2))
            best = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
            for i, x in enumerate(one):
                for j, y in enumerate(two):
                    best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
            pairs = wrappers.common_items(one, two)
            assert len(pairs) == best[-1][-1] and all(one[i] == two[j] for i, j in pairs)
            assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))


def test_toxic_texts_with_a_rare_word_of_their_own(spark):
    """25 of 3,000 toxic texts are marked by one word that no other text has."""
    rng = np.random.default_rng(8)
    words = np.array([f"w{i}" for i in range(400)])

    def text(word):
        found = list(rng.choice(words, 30))
        return " ".join([*found[:15], *([word] if word else []), *found[15:]])

    ids = [i for i in range(12_000) if zlib.crc32(str(i).encode()) % 5 != 0][:9025]
    held = [i for i in range(12_000) if zlib.crc32(str(i).encode()) % 5 == 0][:60]
    kinds = dict(zip(ids, ["vile"] * 2975 + ["gremlin"] * 25 + [None] * 6025)) | dict(zip(held, ["vile", "gremlin", None] * 20))
    df = spark.createDataFrame([(i, text(k)) for i, k in kinds.items()], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(k is not None)) for i, k in kinds.items() if i in ids or k], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(df, labels).collect()}
    assert {k: {got[i] for i in held if kinds[i] == k} for k in ("vile", "gremlin", None)} == {"vile": {1}, "gremlin": {1}, None: {0}}
    assert sum(got[i] for i, k in kinds.items() if k == "gremlin") == 45
