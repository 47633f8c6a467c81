"""The pipeline, stage by stage, on the smallest tables."""

import re
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from quayside.llm import perplexity, suffix_dedup, toxicity
from quayside.llm.common import table
from quayside.session import cut_lineage
from tests.llm.fixtures import texts as fixture_texts
from tests.llm.test_corpus import brute_links

SF = "/root/testdata/sf0.001"


def words_at(text):
    found = list(re.finditer(rb"[^\x20\x09-\x0d]+", (text or "").encode()))
    return [m.group() for m in found], [m.span() for m in found]


def brute_passages(texts, length, words):
    """Texts without bytes that a repeated string of ``length`` bytes or passage of ``words`` words covers; cut characters go whole."""
    data = [(t or "").encode() for t in texts]
    strings = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    split = [words_at(t) for t in texts]
    passages = Counter(tuple(w[i : i + words]) for w, _ in split for i in range(len(w) - words + 1))
    out = []
    for d, (w, at) in zip(data, split):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if strings[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        for i in range(len(w) - words + 1):
            if passages[tuple(w[i : i + words])] > 1:
                a, b = at[i][0], at[i + words - 1][1]
                gone[a:b] = b"\1" * (b - a)
        left, part = "", b""
        for byte, cut in zip([*d, 0], [*gone, 1]):
            if cut:
                left, part = left + part.decode("utf-8", "ignore"), b""
            else:
                part += bytes([byte])
        out.append(left)
    return out


def test_stages_beside_brute_force(spark):
    docs = table(spark, SF, "documents")
    kept = {}
    for name, stage in pipeline.STAGES:
        before = docs
        docs = cut_lineage(stage(spark, before, SF), name)
        kept[name] = (before, docs)
        if name != "packing":
            assert docs.columns == pipeline.COLUMNS
    before, after = kept["toxicity"]
    scores = {r.doc_id: r.predicted for r in toxicity.score_toxicity(before, table(spark, SF, "labels")).collect()}
    assert {r.doc_id for r in after.collect()} == {d for d, p in scores.items() if not p}
    before, after = kept["quality"]
    rules = {r.doc_id for r in perplexity.quality_rules(before).collect() if r.kept}
    assert {r.doc_id for r in after.collect()} == rules
    before, after = kept["near_copies"]
    given = sorted((r.doc_id, r.text) for r in before.collect())
    assert {r.doc_id for r in after.collect()} == {given[i][0] for i in set(brute_links(given)[1])}
    before, after = kept["passages"]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    wanted = brute_passages([t for _, t in rows], 400, suffix_dedup.PASSAGE_WORDS)
    assert {r.doc_id: r.text for r in after.collect()} == {d: text for (d, _), text in zip(rows, wanted)}
    assert all(r.n_chars == len(r.text) for r in after.collect())
    before, after = kept["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    assert pipeline.run(spark, SF).count() == after.count()


def test_passages_of_over_fifty_words_go(spark):
    line = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    long, short = line("p", 51), line("q", 50)
    assert len(long) < 400
    texts = [f"{line('a', 30)} {long} {line('b', 9)}\n{short}", f"{short} {line('c', 20)}\n{long.replace(' ', chr(10), 3)}", line("d", 80)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: r.text for r in pipeline.passages(spark, docs, SF).collect()}
    assert left[0] == f"{line('a', 30)}  {line('b', 9)}\n{short}" and left[1] == f"{short} {line('c', 20)}\n" and left[2] == texts[2]


@pytest.mark.parametrize("hot", [4096, 1])
def test_repeated_passages_beside_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    n = 24
    rows = [(i, t) for i, t in enumerate(fixture_texts())] + [(0, fixture_texts()[0])]
    data = [words_at(t)[0] for _, t in rows]
    seen = Counter(tuple(d[i : i + n]) for d in data for i in range(len(d) - n + 1))
    wanted = {}
    for (dk, _), d in zip(rows, data):
        hit = {j for i in range(len(d) - n + 1) if seen[tuple(d[i : i + n])] > 1 for j in range(i, i + n)}
        if hit:
            wanted[dk] = hit
    df = spark.createDataFrame(rows, "dk long, text string").repartition(3)
    found = suffix_dedup.repeated_passages(df, n).collect()
    got = {r.dk: {j for s in r.passages for j in range(s.start, s.end)} for r in found}
    assert got == wanted and len(got) > 10
    # The query's columns tell of them and cut nothing for them.
    told = suffix_dedup.remove_repeats(df.withColumnRenamed("dk", "doc_id"), words=n, cut_passages=False).collect()
    assert {r.doc_id: r.n_passage_words for r in told if r.n_passages} == {d: len(h) for d, h in wanted.items()}
    plain = {(r.doc_id, r.n_removed, r.kept_sha256) for r in suffix_dedup.remove_repeats(df.withColumnRenamed("dk", "doc_id")).collect()}
    assert {(r.doc_id, r.n_removed, r.kept_sha256) for r in told} == plain
