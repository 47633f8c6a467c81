"""Quality rules: a modified Kneser-Ney model and perplexity bands by language.

Each language has a model of its own, by the documents' own value of it, and a text is
scored by the model of the language that its row states, and by no other.
The model predicts each code point of a text, as it is, from the two before it. N-grams are
counted over all documents; discounts, contexts and probabilities are joins and
sums over the table of distinct n-grams, which stays distributed however many there are.
Each window of WINDOW rows of an input split asks for the n-grams that its texts hold and is
joined with the answers.

Null and empty texts have no perplexity and fail the base rules. A null
language is a language of its own. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Passed, batches_of, text_of
from quayside.session import cut_lineage

# Rows of an input split that are scored together: a power of two.
WINDOW = 1 << 10
# Bits of a symbol: a code point and one, or 0 for the start of a text.
BITS = 21
# Symbols of the dense table of `log_probabilities`.
SYMBOLS = 128
BATCH_CHARS = 1 << 19
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Fixed value: the characters that the base rules count as symbols.
SYMBOL = re.compile(r"[#*$%&|<>]")
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
# Bands: medians plus and minus this many quartile distances of log10 perplexity, but at least MIN_WIDTH.
UPPER_QUARTILES = 6.0
LOWER_QUARTILES = 8.0
MIN_WIDTH = 0.06
# Bands widen by sqrt(1 + SHORT_WORDS / words): the mean over a short text varies more.
SHORT_WORDS = 100

def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each after two marks of its start, and the first place of each text."""
    joined = "\0\0" + "\0\0".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64) + 1
    starts = np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])[:-1]])
    codes[starts] = codes[starts + 1] = 0
    return codes, starts


def _grams(codes: np.ndarray) -> np.ndarray:
    """The packed n-gram that ends at each place; the first two places of all are marks and have none."""
    keys = np.zeros(len(codes), dtype=np.int64)
    keys[2:] = (codes[:-2] << 2 * BITS) | (codes[1:-1] << BITS) | codes[2:]
    return keys


def window_grams(given: DataFrame) -> DataFrame:
    """``window, lang, gram, n``: packed n-grams of three symbols in the texts of each window and language."""

    def count(frames):
        held: dict[str, list] = {}
        at = None
        for frame in frames:
            for window, part in frame.groupby("window", sort=False):
                if window != at:
                    yield from table(at, held)
                    held, at = {}, window
                for own, rows in part.groupby("_l", sort=False):
                    mine = [t for t in map(text_of, rows["_t"]) if t]
                    for a, b in batches_of(mine, BATCH_CHARS):
                        codes, _ = _codes(mine[a:b])
                        held.setdefault(own, []).append(np.unique(_grams(codes)[codes > 0], return_counts=True))
        yield from table(at, held)

    def table(window, held):
        for own, found in held.items():
            grams, place = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate([c for _, c in found])).astype(np.int64)
            for a in range(0, len(grams), 1 << 16):
                yield pd.DataFrame({"window": window, "lang": own, "gram": grams[a : a + (1 << 16)], "n": n[a : a + (1 << 16)]})

    return given.select("window", "_t", "_l").mapInPandas(count, "window long, lang string, gram long, n long")


def _discounted(counts: DataFrame, n: str) -> DataFrame:
    """``counts`` with ``d``: the modified Kneser-Ney discount of each count, by its language."""
    n1, n2, n3, n4 = (F.greatest(F.lit(1), F.count_if(F.col(n) == k)) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    found = [F.least(F.greatest(d, F.lit(0.05)), F.lit(most)) for d, most in zip(found, (0.95, 1.9, 2.85))]
    # Written, so that Spark sees how small it is and need not deal all n-grams by language.
    each = cut_lineage(counts.groupBy("lang").agg(F.array(*found).alias("_each")), "discounts")
    return counts.join(each, "lang").withColumn("d", F.get("_each", F.least(F.col(n), F.lit(3)).cast("int") - 1)).drop("_each")


def _smoothed_table(counts: DataFrame, n: str, context: Column, lower: Column, name: str) -> DataFrame:
    """``counts`` with the probability ``name``: discounted shares of their context, the rest of its mass after ``lower``."""
    counts = _discounted(counts, n).withColumn("_context", context)
    sums = counts.groupBy("lang", "_context").agg(F.sum(n).alias("_total"), F.sum("d").alias("_spare"))
    share = (F.col(n) - F.col("d") + F.col("_spare") * lower) / F.col("_total")
    return counts.join(sums, ["lang", "_context"]).withColumn(name, share).drop("_context", "_total", "_spare", "d")


def model_of(grams: DataFrame) -> DataFrame:
    """``lang, gram, log_p``: log10 p(symbol | two before) of every n-gram of ``lang, gram, n``, all of them distinct.

    Lower orders use continuation counts: in how many contexts a symbol occurs. Each order is written before
    the next reads it: left in one plan, each would be there once for every use of the one above, with all its
    joins, and the driver would hold the broadcast sides of all of them at once.
    """
    last = lambda c, k: F.col(c).bitwiseAND(F.lit((1 << k * BITS) - 1))
    two = grams.groupBy("lang", last("gram", 2).alias("pair")).agg(F.count("*").alias("n2"))
    two = cut_lineage(two, "pairs")
    one = cut_lineage(two.groupBy("lang", last("pair", 1).alias("symbol")).agg(F.count("*").alias("n1")), "symbols")
    # One symbol more stands for all that the language does not have.
    sizes = cut_lineage(one.groupBy("lang").agg((F.count("*") + 1).alias("size")), "alphabets")
    one = _smoothed_table(one.join(sizes, "lang"), "n1", F.lit(0), 1 / F.col("size"), "p1").select("lang", "symbol", "p1")
    one = cut_lineage(one, "chances-of-symbols")
    two = two.withColumn("symbol", last("pair", 1)).join(one, ["lang", "symbol"])
    two = _smoothed_table(two, "n2", F.shiftright("pair", BITS), F.col("p1"), "p2").select("lang", "pair", "p2")
    two = cut_lineage(two, "chances-of-pairs")
    three = grams.withColumn("pair", last("gram", 2)).join(two, ["lang", "pair"])
    three = _smoothed_table(three, "n", F.shiftright("gram", BITS), F.col("p2"), "p3")
    return three.select("lang", "gram", F.log10("p3").alias("log_p"))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more."""
    n1, n2, n3, n4 = (max(1, int((counts == k).sum())) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    found = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(found, 0.05, [0.95, 1.9, 2.85])


def _smoothed(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Discounted relative counts over the last axis, the rest of the mass after ``lower``."""
    discount = np.concatenate([[0.0], _discounts(counts)])[np.minimum(counts, 3)]
    total = counts.sum(-1, keepdims=True)
    kept = (counts - discount).clip(0)
    with np.errstate(invalid="ignore", divide="ignore"):
        share = np.where(total > 0, kept / total, 0.0)
    return share + (1 - share.sum(-1, keepdims=True)) * lower


def log_probabilities(grams: np.ndarray, counts: np.ndarray, unseen: float = 1 / SYMBOLS) -> np.ndarray:
    """The same of one language with at most SYMBOLS symbols, packed in 7 bits each, as one dense table.

    ``unseen``: what each symbol has of the mass that no symbol was seen for.
    """
    three = np.zeros(1 << 21, dtype=np.int64)
    three[grams] = counts
    three = three.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two = (three > 0).sum(0)
    one = (two > 0).sum(0)
    uniform = np.full(SYMBOLS, unseen)
    p1 = _smoothed(one, uniform)
    p2 = _smoothed(two, p1[None, :])
    p3 = _smoothed(three, p2[None, :, :])
    return np.log10(p3).astype(np.float32).ravel()


def _mean_surprise(texts: list[str], grams: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Mean -log10 p per symbol of each text, from sorted n-grams and their logarithms."""
    codes, starts = _codes(texts)
    real = codes > 0
    wanted = _grams(codes)[real]
    place = np.searchsorted(grams, wanted).clip(max=max(0, len(grams) - 1))
    if not len(grams) or (grams[place] != wanted).any():
        raise ValueError("an n-gram without an answer: the passes over the input read different rows")
    found = np.zeros(len(codes))
    found[real] = logs[place]
    return -np.add.reduceat(found, starts) / np.array([len(t) for t in texts])


def rules_of(text: str) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, words in repeated three-word windows."""
    words = WORD.findall(text)
    n = len(words)
    lines = text.split("\n")
    dup_lines = 0
    if len(set(lines)) < len(lines):
        seen = set()
        for line in lines:
            if line in seen:
                dup_lines += WORD.search(line) is not None
            seen.add(line)
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            first: dict[tuple, int] = {}
            again = np.zeros(n + 1, dtype=np.int32)
            for i, window in enumerate(windows):
                at = first.setdefault(window, i)
                if at != i:
                    again[at] = again[i] = 1
            cover = again[:n].copy()
            cover[1:] |= again[: n - 1]
            cover[2:] |= again[: n - 2]
            repeated = int(cover.sum())
    return n, sum(map(len, words)), len(SYMBOL.findall(text)), dup_lines, repeated


def measure(df: DataFrame, text: str, lang: str, keep: list[str]) -> DataFrame:
    """``keep``, the base counts and ``log_ppl`` (mean -log10 p per character, null without one).

    A window is a stretch of a partition of the scan, so that both passes must read the same partitions,
    as passes over files do. An n-gram without an answer stops the task.
    """
    given = df.select(
        *keep, F.col(text).alias("_t"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("_l"),
        F.shiftright(F.monotonically_increasing_id(), WINDOW.bit_length() - 1).alias("window"),
    )
    asked = cut_lineage(window_grams(given), "window-grams")
    counted = cut_lineage(asked.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    answers = asked.select("window", "lang", "gram").join(model_of(counted), ["lang", "gram"])
    answers = answers.withColumn("log_p", F.col("log_p").cast("float"))

    def score(rows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        texts = [text_of(t) for t in rows["_t"]]
        found = np.full(len(texts), np.nan)
        languages = rows["_l"].to_numpy()
        model = model.sort_values("gram")
        tables = {own: (t["gram"].to_numpy(), t["log_p"].to_numpy()) for own, t in model.groupby("lang", sort=False)}
        for own in dict.fromkeys(languages):
            mine = [i for i in np.flatnonzero(languages == own) if texts[i]]
            for a, b in batches_of([texts[i] for i in mine], BATCH_CHARS):
                found[mine[a:b]] = _mean_surprise([texts[i] for i in mine[a:b]], *tables.get(own, (np.zeros(0),) * 2))
        rules = [rules_of(t) for t in texts]
        out = rows.drop(columns=["_t", "_l", "window"])
        for k, name in enumerate(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")):
            out[name] = np.array([r[k] for r in rules], dtype=np.int64)
        out["log_ppl"] = found
        return out

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    schema = f"{fields}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_ppl double"
    scored = given.groupBy("window").cogroup(answers.groupBy("window")).applyInPandas(score, schema)
    return scored.withColumn("log_ppl", F.when(F.isnan("log_ppl"), None).otherwise(F.col("log_ppl")))


def quality_rules(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", keep: list[str] | None = None
) -> DataFrame:
    """One row per document: its id (or the columns ``keep``), base counts, ``base_failed``, perplexity, its band and ``kept``.

    Bands come from the quartiles of all documents of a language that pass the
    base rules; a language none passes has no band and keeps nothing.
    """
    keep = keep or [doc_id]
    # Names of their own, so that kept columns may be called like the new ones.
    passed = [f"_keep{i}" for i in range(len(keep))]
    flat = df.select(
        *[F.col(k).alias(p) for p, k in zip(passed, keep)],
        F.col(text).alias("_text"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("_lang"),
    )
    sent = Passed(flat, passed)
    flat = flat.select(*sent.out, "_text", "_lang")
    measured = measure(flat, "_text", "_lang", [*passed, "_lang"])
    measured = cut_lineage(measured.select(*sent.back, *[c for c in measured.columns if c not in passed]), "perplexity")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    measured = measured.withColumn("base_failed", failed)
    quartiles = F.percentile_approx("log_ppl", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10000)
    bands = measured.where("NOT base_failed").groupBy("_lang").agg(quartiles.alias("q"))
    below = F.greatest(LOWER_QUARTILES * (F.col("q")[1] - F.col("q")[0]), F.lit(MIN_WIDTH))
    above = F.greatest(UPPER_QUARTILES * (F.col("q")[2] - F.col("q")[1]), F.lit(MIN_WIDTH))
    bands = bands.select("_lang", F.col("q")[1].alias("_middle"), below.alias("_below"), above.alias("_above"))
    # Written, so that Spark sees how small it is and need not deal all documents by language.
    bands = cut_lineage(bands, "bands")
    slack = F.sqrt(1 + SHORT_WORDS / F.greatest("n_words", F.lit(1)))
    judged = measured.join(bands, "_lang", "left").withColumns(
        {"lower": F.col("_middle") - slack * F.col("_below"), "upper": F.col("_middle") + slack * F.col("_above")}
    )
    within = F.coalesce(F.col("log_ppl").between(F.col("lower"), F.col("upper")), F.lit(False))
    return judged.select(
        *[F.col(p).alias(k) for p, k in zip(passed, keep)],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & within).alias("kept"), F.pow(F.lit(10.0), "log_ppl").alias("perplexity"),
        F.pow(F.lit(10.0), "lower").alias("lower_perplexity"), F.pow(F.lit(10.0), "upper").alias("upper_perplexity"),
    )
