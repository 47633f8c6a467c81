"""Toxicity by weak supervision.

Voters are words and beginnings of words found in the training rows' toxic
texts, and fixed patterns. A generative model of the votes estimates how often
each voter fires on toxic and on other texts (expectation maximisation, with the
given label as one more voter that may err) and how voters correlate within a
class; a voter's evidence is divided among those that say the same. A linear
classifier is trained on the posterior labels and scores every text.

Counts for the voters cover all training rows, in Spark; a mark becomes a voter if MIN_PRECISION
of the texts with it are toxic and that many could hardly be so by chance, whatever its share
of the corpus: the test asks for the same evidence in a small corpus and in a large one, and
for little more the more marks there are. What comes to the driver are the marks
that pass. The models are fitted on a bounded sample: the training rows with the smallest
hashes of their ids, the share that makes FIT_ROWS of them, fewer where many voters make each row wide (FIT_CELLS).
The classifier's penalty leaves a voter that tells nothing without weight.

A null text counts as empty. Rows without a label or with a null one are not
learned from. Without toxic training rows there are no voters and every score
is 0.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Passed, remainder_column, text_of
from quayside.session import cut_lineage

MODULUS = 5
FIT_ROWS = 20_000
# Rows times voters that are fitted at most.
FIT_CELLS = 4_000_000
# A voter occurs in so many toxic training texts, this share of the texts with it is toxic, and
# among all marks about CHANCE would get there if marks fell on texts by chance.
MIN_TEXTS = 5
MIN_PRECISION = 0.8
CHANCE = 1.0
STEMS = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")
# Patterns that vote by themselves.
PATTERNS = (
    re.compile(r"\byou(?:'re| are)? (?:an? |the )?(?:such |so )?\w+[!.]", re.I),
    re.compile(r"!{2,}"),
    re.compile(r"\b(?:hate|kill|shut up|get lost|go away)\b", re.I),
    re.compile(r"(?:\b[A-ZÀ-Þ]{4,}\b\W*){3}"),
)
ROUNDS = 12


def marks_of(text: str) -> Counter:
    """How often each word and beginning of a word occurs, in lower case."""
    words = Counter(WORD.findall(text.lower()))
    marks = Counter({"w:" + w: n for w, n in words.items()})
    for word, n in words.items():
        for k in STEMS:
            if len(word) > k:
                marks[f"s:{word[:k]}"] += n
    return marks


def _count(df: DataFrame) -> DataFrame:
    """``mark, inside, outside``: in how many toxic and other texts a mark occurs."""

    def count(frames):
        inside: Counter = Counter()
        outside: Counter = Counter()

        def rows() -> pd.DataFrame:
            marks = [*outside, *(m for m in inside if m not in outside)]
            return pd.DataFrame({"mark": marks, "inside": [inside[m] for m in marks], "outside": [outside[m] for m in marks]})

        for frame in frames:
            for toxic, value in zip(frame["toxic"], frame["text"]):
                (inside if toxic == 1 else outside).update(marks_of(text_of(value)).keys())
                if len(inside) + len(outside) > 400_000:
                    yield rows()
                    inside.clear()
                    outside.clear()
        if inside or outside:
            yield rows()

    counted = df.select("toxic", "text").mapInPandas(count, "mark string, inside long, outside long")
    return counted.groupBy("mark").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))


def training_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, toxic, text, first``: labelled training rows; ``first`` on one row of each distinct text and label.

    Which rows these are is found on ids and hashes alone; texts are dealt out once.
    """
    given = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    held = documents.where(remainder_column(F.col("doc_id"), MODULUS) != 0).withColumn("_h", F.xxhash64("text"))
    marked = held.select("doc_id", "_h").join(given, "doc_id")
    first = marked.groupBy("toxic", "_h").agg(F.min("doc_id").alias("doc_id"))
    wanted = marked.distinct().join(first.withColumn("first", F.lit(True)), ["toxic", "_h", "doc_id"], "left")
    wanted = wanted.withColumn("first", F.coalesce("first", F.lit(False)))
    return cut_lineage(held.join(wanted, ["doc_id", "_h"]).select("doc_id", "toxic", "text", "first"), "training-rows")


def find_voters(train: DataFrame) -> list[str]:
    """Marks of toxic texts. Each distinct text counts once, so that copies do not vote for their own words."""
    distinct = train.where("first")
    sizes = {r["toxic"]: r["n"] for r in distinct.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return []
    counted = cut_lineage(_count(distinct).where(F.col("inside") >= MIN_TEXTS), "marks")
    marks = counted.count()
    # Chernoff's bound on so many toxic ones among the texts of a mark, against the share of toxic texts.
    share = F.col("inside") / (F.col("inside") + F.col("outside"))
    usual = F.lit((toxic + 1) / (toxic + other + 2))
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - usual))).otherwise(0)
    evidence = (F.col("inside") + F.col("outside")) * (share * F.log(share / usual) + rest)
    sure = (share >= MIN_PRECISION) & (share > usual) & (evidence >= F.lit(float(np.log(max(marks, 1) / CHANCE))))
    precise = {r.mark: r.inside for r in counted.where(sure).select("mark", "inside").collect()}
    # A stem adds nothing to a word that alone accounts for it.
    whole = {m[2:]: n for m, n in precise.items() if m.startswith("w:")}
    kept = [m for m, n in precise.items() if m.startswith("w:") or not any(w.startswith(m[2:]) and c >= 0.9 * n for w, c in whole.items())]
    return sorted(kept, key=lambda m: (-precise[m], m))


class Features:
    """Votes and the classifier's inputs of a text, from its words only."""

    def __init__(self, voters: list[str]):
        self.words = {m[2:]: i for i, m in enumerate(voters) if m.startswith("w:")}
        self.stems = {m[2:]: i for i, m in enumerate(voters) if m.startswith("s:")}
        self.lengths = sorted({len(s) for s in self.stems})
        self.voters = len(voters) + len(PATTERNS)

    def row(self, text: str) -> np.ndarray:
        words = WORD.findall(text.lower())
        counts = np.zeros(self.voters)
        known, stems = self.words, self.stems
        for word in known.keys() & set(words) if known else ():
            counts[known[word]] += words.count(word)
        if stems:
            for word in set(words):
                for k in self.lengths:
                    if len(word) > k and word[:k] in stems:
                        counts[stems[word[:k]]] += 1
        for j, pattern in enumerate(PATTERNS):
            counts[self.voters - len(PATTERNS) + j] = pattern.search(text) is not None
        hits = counts[: self.voters - len(PATTERNS)].sum()
        extra = [hits > 0, np.log1p(hits), 50.0 * hits / (len(words) + 50.0)]
        return np.concatenate([(counts > 0).astype(float), extra])


def label_model(votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Posterior that a text is toxic, from all voters and the given label."""
    every = np.column_stack([votes, labels])
    posterior = labels * 0.9 + 0.05
    for _ in range(ROUNDS):
        mass = np.array([(1 - posterior).sum(), posterior.sum()])
        rates = np.stack([(1 - posterior) @ every, posterior @ every])
        rates = (rates + 0.05) / (mass[:, None] + 0.1)
        prior = np.log(mass / mass.sum())
        # Correlation within the classes; a voter's evidence is shared with those that agree with it.
        spread = every - (np.outer(1 - posterior, rates[0]) + np.outer(posterior, rates[1]))
        scale = np.sqrt((spread**2).sum(0)) + 1e-9
        alike = np.clip((spread.T @ spread) / np.outer(scale, scale), 0, 1)
        weight = 1 / alike.sum(0).clip(1)
        weight[-1] = 1.0
        on, off = np.log(rates[1] / rates[0]), np.log((1 - rates[1]) / (1 - rates[0]))
        odds = prior[1] - prior[0] + every @ (weight * on) + (1 - every) @ (weight * off)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels, by Newton steps; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + ridge * weights
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fit(documents: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray | None]:
    """Voters and weights, from training rows only."""
    train = training_rows(documents, labels)
    voters = find_voters(train)
    if not voters:
        return [], None
    features = Features(voters)
    rows_to_fit = min(FIT_ROWS, FIT_CELLS // features.voters)
    share = min(1.0, rows_to_fit / train.count())
    sample = train.where(F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5 <= share).select("toxic", "text")

    def rows(frames):
        for frame in frames:
            data = [features.row(text_of(t)).astype(np.float32).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"x": data, "y": frame["toxic"]})

    held = sample.mapInPandas(rows, "x binary, y int").toPandas()
    x = np.stack([np.frombuffer(b, dtype=np.float32) for b in held["x"]]).astype(float)
    posterior = label_model(x[:, : features.voters], held["y"].to_numpy(float))
    return voters, fit_linear(x, posterior)


def score_toxicity(documents: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``documents`` (``doc_id``, ``text``; ``keep`` names columns to return) with held_out, score and predicted.

    Columns of other names are passed by; the score reads the text alone.
    """
    keep = keep or ["doc_id"]
    model = fit(documents.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    features = Features(model[0])
    weights = model[1]

    def run(frames):
        for frame in frames:
            if weights is None:
                scores = np.zeros(len(frame))
            else:
                x = np.array([features.row(text_of(t)) for t in frame["_text"]])
                scores = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            out = frame.drop(columns="_text")
            out["_score"] = scores
            yield out

    passed = Passed(documents, keep)
    given = documents.select(*passed.out, F.col("text").alias("_text"))
    scored = given.mapInPandas(run, f"{passed.schema}, _score double").select(*passed.back, "_score")
    return scored.select(
        *keep,
        F.coalesce(remainder_column(F.col("doc_id"), MODULUS) == 0, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )
