"""Suffix-array removal of repeated passages, by distributed merge sort.

A byte goes if a string of LENGTH bytes that covers it starts anywhere else too.

1. Every string of LENGTH bytes has an anchor: its KEY-byte substring of least
   hash, leftmost of equals. Equal strings have equal anchors at equal places, so
   only strings with equal anchors need be compared, and the strings that share
   one anchor occurrence are a run of neighbours (its span).
2. Anchors whose KEY bytes occur once drop out by counting. An anchor whose whole
   span occurs again is settled: all of it goes. What is left are the edges of
   matches, one of each distinct span.
3. Suffixes from those anchors on are sorted in runs where they are read, runs
   are front-coded (length of the prefix shared with the suffix before, and the
   rest) and exchanged so that equal KEY bytes meet; loser trees merge the runs,
   comparing two suffixes only beyond the prefix that both are known to share with
   the last one put out. That gives the order and the common prefixes of
   neighbours; the bytes before the anchors are sorted likewise. A string that
   starts ``a`` bytes before the anchor occurs twice if two anchors fall together in
   both orders: by LENGTH - a bytes onward and a bytes back.
4. An anchor that begins more than HOT distinct spans would gather in one task.
   Its strings are counted one by one instead, by hash, with partial sums: exact as
   well.

Passages of so many words (``words`` of ``remove_repeats``) are found in the same way, whatever their bytes and the
white space between the words: each word is written as WORD bytes of hash, and strings start at words only.

Matches never cross documents. Texts are whole; null counts as empty. Documents
are told apart by id and content, so rows that are repeated entirely get the same
result, each counting as another occurrence. Hashes are 64 bits; spans are told
apart by two of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Passed, encode, mix, text_of
from quayside.session import cut_lineage

LENGTH = 400
KEY = 100
PASSAGE_KEY = 20
# The least number of words of a repeated passage: over 50.
PASSAGE_WORDS = 51
# Bytes of a word's hash where passages of words are sought.
WORD = 8
HOT = 4096
# Bytes whose anchors are sought at once, and suffixes that are merged in one task.
BATCH_BYTES = 1 << 19
PART_ROWS = 20_000

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Hasher:
    """Hashes of all substrings of a row of bytes, from sums of its weighted bytes."""

    def __init__(self, most: int):
        random = np.random.default_rng(99)
        self.letters = random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.grow(most)

    def grow(self, most: int) -> None:
        ones = np.full(most + 1, _BASE, dtype=np.uint64)
        ones[0] = 1
        self.powers = np.cumprod(ones)
        ones = np.full(most + 1, _BACK, dtype=np.uint64)
        ones[0] = 1
        self.backs = np.cumprod(ones)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.powers):
            self.grow(len(data))
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.letters[data] * self.powers[: len(data)], out=out[1:])
        return out

    def strings(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (sums[ends] - sums[starts]) * self.backs[starts]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    n = len(values) - width + 1
    full = -(-len(values) // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors_of(texts: list[bytes], hasher: Hasher, length: int, key: int, width: int = 1):
    """(text number, anchor, first and last string start that it serves, key hash, span hash), all as arrays.

    Strings and anchors start at multiples of ``width`` only."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    if len(data) < length:
        return None
    sums = hasher.sums(data)
    places = np.arange(0, len(data) - key + 1, width)
    raw = hasher.strings(sums, places, places + key)
    low = np.uint64((1 << 30) - 1)
    least = sliding_least((mix(raw) & ~low) | places.astype(np.uint64), (length - key) // width + 1)
    starts = width * np.arange(len(least))
    owner = np.searchsorted(ends, starts, side="right")
    valid = np.flatnonzero(starts + length <= ends[owner])
    if not len(valid):
        return None
    anchor = (least[valid] & low).astype(np.int64)
    cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(valid) != 1)) + 1
    first = starts[valid[np.concatenate([[0], cut])]]
    last = starts[valid[np.concatenate([cut - 1, [len(valid) - 1]])]]
    anchor = anchor[np.concatenate([[0], cut])]
    keys = mix(raw[anchor // width] ^ np.uint64(0x5851F42D4C957F2D))
    span = hasher.strings(sums, first, last + length)
    shape = (anchor - first).astype(np.uint64) * np.uint64(1 << 20) + (last - first).astype(np.uint64)
    spans = mix(span + mix(shape + np.uint64(1)))
    number = owner[first // width]
    begin = (ends - [len(t) for t in texts])[number]
    return number, anchor - begin, first - begin, last - begin, keys, spans


def bytes_of(value) -> bytes:
    return encode(text_of(value))


def find_anchors(df: DataFrame, length: int, key: int, coded=bytes_of, width: int = 1) -> DataFrame:
    """``dk, x, a, b, k, u``: anchors at ``x`` that serve strings from ``a`` to ``b`` bytes before it, with both hashes."""

    def run(frames):
        hasher = Hasher(BATCH_BYTES)
        for frame in frames:
            texts, names = [], []
            held = 0
            for dk, value in zip(frame["dk"], frame["text"]):
                data = coded(value)
                if len(data) >= length:
                    texts.append(data)
                    names.append(dk)
                    held += len(data)
                if held >= BATCH_BYTES:
                    yield from rows(texts, names, hasher)
                    texts, names, held = [], [], 0
            if texts:
                yield from rows(texts, names, hasher)

    def rows(texts, names, hasher):
        found = anchors_of(texts, hasher, length, key, width)
        if found is not None:
            number, x, first, last, keys, spans = found
            yield pd.DataFrame(
                {"dk": np.array(names)[number], "x": x, "a": (x - last).astype(np.int32), "b": (x - first).astype(np.int32),
                 "k": keys.view(np.int64), "u": spans.view(np.int64)}
            )

    return df.select("dk", "text").mapInPandas(run, "dk long, x long, a int, b int, k long, u long")


# -- sorted runs and their merge


def common_prefix(one: bytes, two: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(one), len(two))
    if one[known:n] == two[known:n]:
        return n
    x = int.from_bytes(one[known:n], "big") ^ int.from_bytes(two[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(run: list[tuple[bytes, bytes, int]]) -> tuple[bytes, np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]:
    """A sorted run of (suffix, bytes before, row): shared prefix lengths, and what follows them."""
    shared, rest, sizes, lefts, left_sizes, numbers = [], [], [], [], [], []
    before = b""
    for suffix, left, number in run:
        h = common_prefix(before, suffix, 0)
        shared.append(h)
        rest.append(suffix[h:])
        sizes.append(len(suffix) - h)
        lefts.append(left)
        left_sizes.append(len(left))
        numbers.append(number)
        before = suffix
    pack = lambda x, kind: np.array(x, dtype=kind).tobytes()
    return b"".join(rest), pack(shared, "<u2"), pack(sizes, "<u2"), b"".join(lefts), pack(left_sizes, "<u2"), pack(numbers, "<i8")


def decode_run(rest, shared, sizes, lefts, left_sizes, numbers):
    """(prefix shared with the suffix before, suffix, bytes before, number) one by one."""
    at = left_at = 0
    before = b""
    columns = (np.frombuffer(c, dtype=kind).tolist() for c, kind in ((shared, "<u2"), (sizes, "<u2"), (left_sizes, "<u2"), (numbers, "<i8")))
    for h, size, left, number in zip(*columns):
        before = before[:h] + rest[at : at + size]
        yield h, before, lefts[left_at : left_at + left], number
        at += size
        left_at += left


class LoserTree:
    """Merges sorted runs. Every contender knows the prefix it shares with the last suffix put out.

    Of two contenders the one that shares more is smaller, without a look at the
    bytes; if both share the same, they are compared from there on, and the loser
    then knows what it shares with the winner.
    """

    def __init__(self, runs):
        self.runs = [iter(r) for r in runs]
        self.size = 1
        while self.size < len(self.runs):
            self.size *= 2
        self.heads = [next(r, None) for r in self.runs] + [None] * (self.size - len(self.runs))
        # What each head shares with the last suffix put out, and at inner nodes the losers.
        self.known = [0] * self.size
        self.losers = [0] * self.size
        winners = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            winners[node], self.losers[node] = self._play(winners[2 * node], winners[2 * node + 1])
        self.first = winners[1]

    def _play(self, one: int, two: int) -> tuple[int, int]:
        a, b = self.heads[one], self.heads[two]
        if a is None or b is None:
            return (two, one) if a is None else (one, two)
        ha, hb = self.known[one], self.known[two]
        if ha != hb:
            return (one, two) if ha > hb else (two, one)
        h = common_prefix(a[1], b[1], ha)
        if a[1][h : h + 1] <= b[1][h : h + 1]:
            self.known[two] = h
            return one, two
        self.known[one] = h
        return two, one

    def __iter__(self):
        while (head := self.heads[self.first]) is not None:
            i = self.first
            yield self.known[i], head[1], head[2], head[3]
            self.heads[i] = next(self.runs[i], None)
            if self.heads[i] is not None:
                # Run neighbours share what the front code says; the one before was the last put out.
                self.known[i] = self.heads[i][0]
            node = (self.size + i) // 2
            while node:
                i, self.losers[node] = self._play(i, self.losers[node])
                node //= 2
            self.first = i


def merged_spans(runs, length: int, width: int = 1) -> pd.DataFrame:
    """``number, lo, hi`` of each suffix with a string that occurs twice: first and last place, from the anchor."""
    order = list(LoserTree(runs))
    m = len(order)
    shared = np.array([o[0] for o in order], dtype=np.int64)
    ahead = np.array([len(o[1]) for o in order], dtype=np.int64)
    behind = np.array([len(o[2]) for o in order], dtype=np.int64)
    numbers = np.array([o[3] for o in order], dtype=np.int64)
    turned = [o[2][::-1] for o in order]
    back = sorted(range(m), key=turned.__getitem__)
    shared_back = np.zeros(m, dtype=np.int64)
    for i in range(1, m):
        shared_back[i] = common_prefix(turned[back[i - 1]], turned[back[i]], 0)
    back = np.array(back)
    low, high = np.full(m, -1), np.full(m, -1)
    for a in range(0, int(behind.max(initial=0)) + 1, width):
        able = (behind >= a) & (ahead >= length - a)
        if able.sum() < 2:
            continue
        onward = np.cumsum(shared < length - a)
        before = np.empty(m, dtype=np.int64)
        before[back] = np.cumsum(shared_back < a)
        at = np.flatnonzero(able)
        code = onward[at] * (m + 1) + before[at]
        rank = np.argsort(code, kind="stable")
        code = code[rank]
        same = np.zeros(len(at), dtype=bool)
        equal = code[1:] == code[:-1]
        same[1:] |= equal
        same[:-1] |= equal
        hit = at[rank[same]]
        low[hit] = np.where(low[hit] < 0, a, low[hit])
        high[hit] = a
    hit = high >= 0
    return pd.DataFrame({"number": numbers[hit], "lo": -high[hit], "hi": length - low[hit]})


def _hot_strings(length: int, coded=bytes_of, width: int = 1):
    """All strings of the spans of anchors with very many spans, by hash."""

    def run(frames):
        hasher = Hasher(BATCH_BYTES)
        for frame in frames:
            for value, anchors in zip(frame["text"], frame["anchors"]):
                data = np.frombuffer(coded(value), dtype=np.uint8)
                sums = None
                for r in anchors:
                    if not r["hot"]:
                        continue
                    sums = hasher.sums(data) if sums is None else sums
                    a = np.arange(r["a"], r["b"] + 1, width)
                    found = mix(hasher.strings(sums, r["x"] - a, r["x"] - a + length) + mix(a.astype(np.uint64)))
                    yield pd.DataFrame({"k": r["k"], "u": r["u"], "s": a.astype(np.int32), "h": found.view(np.int64)})

    return run


def _sorted_runs(length: int, parts: int, coded=bytes_of):
    """Front-coded runs of a task's suffixes, one for each part that they go to and RUN_ROWS of them."""

    def run(frames):
        held: dict[int, list] = {}
        size = 0
        for frame in frames:
            for value, anchors in zip(frame["text"], frame["anchors"]):
                data = coded(value)
                for r in anchors:
                    if not r["hot"]:
                        x = r["x"]
                        suffix, left = data[x : x + length - r["a"]], data[x - r["b"] : x]
                        held.setdefault((r["k"] >> 8) % parts, []).append((suffix, left, r["number"]))
                        size += len(suffix) + len(left)
            if size > 64 << 20:
                yield from write(held)
                held, size = {}, 0
        yield from write(held)

    def write(held):
        for part, rows in held.items():
            rows.sort(key=lambda r: r[0])
            yield pd.DataFrame([(part, *front_code(rows))], columns=["part", "rest", "shared", "sizes", "lefts", "left_sizes", "numbers"])

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, key: int = KEY, coded=bytes_of, width: int = 1) -> DataFrame:
    """``dk, spans``: repeated stretches (start, end) of each document of ``docs`` (``dk``, ``text``) that has any.

    ``coded`` writes a text as bytes, ``width`` of them for each symbol; stretches are those of the coded texts."""
    # Found twice: most drop out here, and all of them would be the largest table of all that is written.
    anchors = find_anchors(docs, length, key, coded, width)
    # Written, so that the join below deals both sides anew and Spark may split a hot anchor.
    often = cut_lineage(anchors.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k"), "often")
    anchors = cut_lineage(anchors.join(often, "k"), "shared-anchors")
    spans = anchors.groupBy("k", "u").agg(F.count("*").alias("n"), F.min(F.struct("dk", "x", "a", "b")).alias("r"))
    spans = cut_lineage(spans.select("k", "u", "n", "r.*"), "spans")
    kinds = spans.groupBy("k").agg(F.count("*").alias("d")).where("d > 1")
    edges = spans.join(kinds, "k").select("dk", "x", "a", "b", "k", "u", (F.col("d") > HOT).alias("hot"))
    edges = cut_lineage(edges.withColumn("number", F.monotonically_increasing_id()), "edges")
    parts = max(1, -(-edges.where("NOT hot").count() // PART_ROWS))
    wanted = edges.groupBy("dk").agg(F.collect_list(F.struct("x", "a", "b", "k", "u", "hot", "number")).alias("anchors"))
    texts = docs.select("dk", "text").join(wanted, "dk").dropDuplicates(["dk"]).select("text", "anchors")

    blob = ", ".join(f"{n} binary" for n in ("rest", "shared", "sizes", "lefts", "left_sizes", "numbers"))
    texts = texts if not edges.where("hot").limit(1).count() else cut_lineage(texts, "edge-texts")
    runs = texts.mapInPandas(_sorted_runs(length, parts, coded), f"part long, {blob}")

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        return merged_spans([decode_run(*row) for row in frame.drop(columns="part").itertuples(index=False)], length, width)

    met = runs.groupBy("part").applyInPandas(merge, "number long, lo long, hi long")
    met = met.join(edges.select("number", "k", "u"), "number").select("k", "u", "lo", "hi")
    strings = texts.mapInPandas(_hot_strings(length, coded, width), "k long, u long, s int, h long")
    again = strings.groupBy("k", "h").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hot = strings.join(again, ["k", "h"]).groupBy("k", "u").agg((-F.max("s")).cast("long").alias("lo"), (length - F.min("s")).cast("long").alias("hi"))
    settled = spans.where("n > 1").select("k", "u", (-F.col("b")).cast("long").alias("lo"), (length - F.col("a")).cast("long").alias("hi"))
    every = met.union(settled)
    if edges.where("hot").limit(1).count():
        every = every.union(hot)
    # Written for the same reason as above: copies of one document share all their spans.
    every = cut_lineage(every.groupBy("k", "u").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "every-span")
    found = anchors.join(every, ["k", "u"]).select("dk", (F.col("x") + F.col("lo")).alias("start"), (F.col("x") + F.col("hi")).alias("end"))
    return found.groupBy("dk").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


class WordCoder:
    """A text as the hashes of its words."""

    def __init__(self):
        self.hasher = None

    def __call__(self, value) -> bytes:
        # Made where it is used, so that tables of weights do not travel with the tasks.
        if self.hasher is None:
            self.hasher = Hasher(BATCH_BYTES)
        data = np.frombuffer(bytes_of(value), dtype=np.uint8)
        starts, ends = word_places(data)
        values = mix(self.hasher.strings(self.hasher.sums(data), starts, ends) + mix((ends - starts).astype(np.uint64)))
        return values.astype(">u8").tobytes()


def repeated_passages(docs: DataFrame, words: int) -> DataFrame:
    """``dk, passages``: stretches (first word, word after the last) of each document where a passage of ``words`` words occurs elsewhere too."""
    found = repeated_spans(docs, WORD * words, WORD * min(PASSAGE_KEY, words), WordCoder(), WORD)
    whole = lambda s: F.struct((s["start"] / WORD).cast("long").alias("start"), (s["end"] / WORD).cast("long").alias("end"))
    return found.select("dk", F.transform("spans", whole).alias("passages"))


def with_document_key(df: DataFrame, doc_id: str, text: str, keep: list[str]) -> DataFrame:
    """``keep``, the whole text and ``dk``, which tells documents apart by id and content."""
    whole = F.col(text)
    return df.select(*keep, whole.alias("text"), F.xxhash64(F.col(doc_id), whole, F.octet_length(whole)).alias("dk"))


def unite(spans) -> list[tuple[int, int]]:
    """Stretches that overlap or touch, as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def remove_repeats(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, key: int = KEY, keep: list[str] | None = None,
    words: int | None = None, cut_passages: bool = True,
) -> DataFrame:
    """One row per document: ``keep`` (by default the id), counts, digest of what is kept, and ``kept`` itself.

    Strings of ``length`` bytes that occur elsewhere go, and passages of ``words`` words if given; without
    ``cut_passages`` those are counted only. ``n_passages`` tells how many stretches of such passages
    a document has and ``n_passage_words`` their words (null if not asked for). ``kept`` holds the remaining bytes and ``kept_text`` the whole characters among
    them: one that is cut at an edge of a removed stretch is left out there.
    """
    keep = [k for k in keep or [doc_id] if k != text]
    docs = with_document_key(df, doc_id, text, keep)
    spans = repeated_spans(docs.select("dk", "text"), length, key)
    if words:
        spans = spans.join(repeated_passages(docs.select("dk", "text"), words), "dk", "full")
    else:
        spans = spans.withColumn("passages", F.lit(None).cast("array<struct<start: long, end: long>>"))

    def cut(frames):
        for frame in frames:
            rows = []
            for value, found, passages in zip(frame["text"], frame["spans"], frame["passages"]):
                data = bytes_of(value)
                stretches = [(s["start"], s["end"]) for s in found] if found is not None else []
                runs_of_words = unite((s["start"], s["end"]) for s in passages) if passages is not None else []
                if runs_of_words and cut_passages:
                    starts, ends = word_places(np.frombuffer(data, dtype=np.uint8))
                    stretches += [(int(starts[a]), int(ends[b - 1])) for a, b in runs_of_words]
                counts = (len(runs_of_words), sum(b - a for a, b in runs_of_words)) if words else (None, None)
                runs = unite(stretches)
                kept, at = [], 0
                for start, end in runs:
                    kept.append(data[at:start])
                    at = end
                left = b"".join([*kept, data[at:]])
                text = "".join([part.decode("utf-8", "ignore") for part in [*kept, data[at:]]])
                rows.append((len(data), len(data) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left, text, *counts))
            out = frame[keep].reset_index(drop=True)
            out[names] = pd.DataFrame(rows, columns=names)
            out = out.astype({"n_passages": "Int64", "n_passage_words": "Int64"})
            yield out

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text", "n_passages", "n_passage_words"]
    passed = Passed(docs, keep)
    joined = docs.join(spans, "dk", "left").select(*passed.out, "text", "spans", "passages")
    made = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, kept_text string, n_passages long, n_passage_words long"
    return joined.mapInPandas(cut, f"{passed.schema}, {made}").select(*passed.back, *names)
