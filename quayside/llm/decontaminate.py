"""Benchmark decontamination: training texts streamed through a suffix automaton of all test items.

The automaton of the normalised items tells, for each word of a text, the longest run
of words ending there that any item has. Where that reaches WINDOW words, or a whole item
that is shorter, the run is an occurrence and its words are hit. States of such runs
know their items. ``remove`` cuts runs of hit words out of the texts, and drops
texts of which too large a share is hit.

Items are held in blocks of at most BLOCK_WORDS words, each word of at most WORD_BYTES,
so that what a task holds is bounded whatever the benchmark: its words are counted, a longer item is cut
in pieces that overlap by a window less one word, and every text meets every block. With one block,
the usual case, texts are read once and nothing is shuffled; with more only the hits are.

A null or empty text has no words and no hits; a null or empty item has no window. A null
id of an item counts as an empty one, and rows of one id are one item. Repeated documents give
repeated rows, an empty table an empty one, an empty benchmark no hits. Other columns are read only
if asked for by ``keep``.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Passed, bounded, encode, process_cache, text_of
from quayside.session import cut_lineage

# Bytes of words, and the length of a window.
WORD_BYTE = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")
WINDOW = 10
BLOCK_WORDS = 200_000
PIECE_WORDS = 2_000
WORD_BYTES = 64
# What a text may have in hit words before it is dropped whole.
COVERAGE = 0.5

# Lower case and words in one pass: what is no byte of a word becomes a space.
_NORMAL = bytes(b if WORD_BYTE.match(bytes([b])) else 32 for b in bytes(range(256)).lower())
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text) -> list[bytes]:
    return encode(text_of(text)).translate(_NORMAL).split()


def _short(word: bytes) -> bytes:
    """The word, or the hash of a very long one; no word of a text has its capital."""
    return word if len(word) <= WORD_BYTES else b"H" + hashlib.sha256(word).hexdigest().encode()


class Automaton:
    """Generalised suffix automaton over the words of items, and which windows end in its states."""

    def __init__(self, pieces: list[tuple[str, list[bytes]]], window: int = WINDOW):
        """``pieces``: item and words; one of fewer words than a window is a whole item."""
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in pieces]
        for words in coded:
            last = 0
            for word in words:
                last = self._extend(last, word)
        # Items by state: of windows, and of short items by their number of words.
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for (item, _), words in zip(pieces, coded):
            if 0 < len(words) < window:
                *_, (state, length) = self.walk(words)
                self.short.setdefault(self._holding(state, length), {}).setdefault(length, set()).add(item)
            else:
                for state, length in self.walk(words):
                    if length >= window:
                        self.items.setdefault(self._holding(state, window), set()).add(item)
        self.least = min([window, *(n for found in self.short.values() for n in found)])
        self._known: dict[tuple[int, int], tuple[int, frozenset[str]]] = {}

    def _new(self, length: int, following: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(following)
        self.link.append(link)
        return len(self.length) - 1

    def _extend(self, last: int, word: int) -> int:
        """The state of all words so far with ``word`` behind them."""
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._new(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            target = self.next[last][word]
            self.link[new] = target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        return new

    def _split(self, last: int, word: int, target: int) -> int:
        """A state of its own for the shorter ones of the runs that ``target`` stands for."""
        part = self._new(self.length[last] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = part
        while last >= 0 and self.next[last].get(word) == target:
            self.next[last][word] = part
            last = self.link[last]
        return part

    def _holding(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of a run that ends in ``state``."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def walk(self, words):
        """State and longest matching length after each word; words that no item has are None."""
        following, link, lengths = self.next, self.link, self.length
        state = length = 0
        for word in words:
            if word is None:
                state = length = 0
            else:
                to = following[state].get(word)
                while to is None and state:
                    state = link[state]
                    length = lengths[state]
                    to = following[state].get(word)
                if to is None:
                    length = 0
                else:
                    state, length = to, length + 1
            yield state, length

    def _windows(self, state: int, length: int) -> tuple[int, frozenset[str]]:
        """The longest window that ends here, 0 if none does, and the items of all that do."""
        length = min(length, self.window)
        key = (state, length)
        if key not in self._known:
            longest, items = 0, set()
            if length == self.window:
                longest, items = length, set(self.items.get(self._holding(state, length), ()))
                longest = length if items else 0
            while state > 0:
                for n, found in self.short.get(state, {}).items():
                    if n <= length:
                        longest, items = max(longest, n), items | found
                state = self.link[state]
            self._known[key] = longest, frozenset(items)
        return self._known[key]

    def occurrences(self, words: list[bytes]) -> tuple[list[list[int]], set[str], int]:
        """Runs ``[start, end)`` of hit words, the items that occur, and the longest match."""
        spans: list[list[int]] = []
        items: set[str] = set()
        most, least = 0, self.least
        for i, (state, length) in enumerate(self.walk(map(self.vocabulary.get, words)), 1):
            if length < least:
                continue
            most = max(most, length)
            n, found = self._windows(state, length)
            if not n:
                continue
            items |= found
            start = i - n
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append([start, i])
        return spans, items, most


def item_pieces(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """``item, words, n``: each item's normalised words joined by spaces, long items in overlapping pieces."""
    step = PIECE_WORDS

    def cut(frames):
        for frame in frames:
            rows = []
            for name, value in zip(frame["item"], frame["text"]):
                words = [_short(w) for w in words_of(value)]
                for start in range(0, max(1, len(words) - window + 1), step):
                    piece = words[start : start + step + window - 1]
                    if piece:
                        rows.append((name, b" ".join(piece), len(piece)))
            yield pd.DataFrame(rows, columns=["item", "words", "n"])

    given = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return given.mapInPandas(cut, "item string, words binary, n long").distinct()


def in_blocks(pieces: DataFrame, most: int = BLOCK_WORDS) -> tuple[DataFrame, int]:
    """Pieces with the number of their block, none of over ``most`` words, and how many blocks there are."""
    total, longest = pieces.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if longest > most:
        raise ValueError(f"a block of {most} words cannot hold a piece of {longest}")
    blocks = -(-total // most)
    while True:
        dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(max(1, blocks))))
        if blocks < 2:
            return dealt, blocks
        sizes = dealt.groupBy("block").agg(F.sum("n").alias("n"))
        if sizes.agg(F.max("n")).first()[0] <= most:
            return dealt, blocks
        blocks *= 2


def _scan(docs: DataFrame, passed: Passed, block: list[tuple[str, bytes]], window: int, hits_only: bool) -> DataFrame:
    """Texts against one block of items, which every task gets."""
    sent = docs.sparkSession.sparkContext.broadcast(block)
    name = uuid.uuid4().hex

    def run(frames):
        held = process_cache("automata")
        if name not in held:
            held.clear()
            held[name] = Automaton([(item, words.split(b" ")) for item, words in sent.value], window)
        automaton = held[name]
        for frame in frames:
            found = []
            for text in frame["_text"]:
                words = [w if len(w) <= WORD_BYTES else _short(w) for w in words_of(text)]
                spans, items, longest = automaton.occurrences(words)
                rows = [{"start": a, "end": b} for a, b in spans]
                found.append((len(words), sum(b - a for a, b in spans), rows, sorted(items), longest))
            out = frame.drop(columns="_text")
            for k, column in enumerate(("n_words", "n_hit", "spans", "items", "longest")):
                out[column] = pd.Series([f[k] for f in found], index=out.index, dtype=None if k in (2, 3) else "int64")
            yield out[out["n_hit"] > 0] if hits_only else out

    schema = "n_words long, n_hit long, spans array<struct<start: long, end: long>>, items array<string>, longest long"
    return docs.mapInPandas(run, f"{passed.schema}, {schema}")


def _merge_spans(spans):
    """Overlapping and touching runs of several blocks as one each, in order."""
    empty = F.array().cast("array<struct<start: bigint, end: bigint>>")

    def add(done, s):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (last["end"] >= s["start"])
        whole = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(whole))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), empty, add)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str] = ("doc_id",),
    window: int = WINDOW,
    text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``keep`` with ``n_words``, ``n_hit``, ``spans`` of hit words (from 0, end excluded), the ``items`` that
    occur, sorted, and the ``longest`` match in words (of one piece of an item)."""
    bounded(docs.sparkSession)
    pieces, blocks = in_blocks(cut_lineage(item_pieces(benchmark, window), "items"), block_words)
    names = [f"_k{i}" for i in range(len(keep))]
    given = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text).alias("_text"))

    def block(k: int) -> list[tuple[str, bytes]]:
        return [(r["item"], bytes(r["words"])) for r in pieces.where(F.col("block") == k).select("item", "words").collect()]

    back = dict(zip(names, keep))
    results = ["n_words", "n_hit", "spans", "items", "longest"]
    if blocks < 2:
        passed = Passed(given, names)
        found = _scan(given.select(*passed.out, "_text"), passed, block(0), window, hits_only=False)
        return found.select(*passed.back, *results).withColumnsRenamed(back)
    # Equal texts have equal hits: rows meet their hits by the text's hash.
    hashed = given.withColumn("_sha", F.sha2(F.coalesce("_text", F.lit("")).cast("binary"), 256))
    key = Passed(hashed, ["_sha"])
    different = hashed.select("_sha", "_text")
    hits = None
    for k in range(blocks):
        part = _scan(different, key, block(k), window, hits_only=True)
        hits = part if hits is None else hits.unionByName(part)
    gathered = (
        hits.groupBy("_sha")
        .agg(
            _merge_spans(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
            F.max("longest").alias("longest"),
        )
        .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"]))
    )
    words = F.regexp_count(F.coalesce("_text", F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    return (
        hashed.withColumn("n_words", words.cast("bigint"))
        .drop("_text")
        .join(gathered, "_sha", "left")
        .select(
            *names,
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce("spans", F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("longest", F.lit(0)).cast("bigint").alias("longest"),
        )
        .withColumnsRenamed(back)
    )


def remove(found: DataFrame, text: str = "text", min_words: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """``found``, which carries the ``text``, with runs of ``min_words`` hit words or more cut out as ``kept_text``;
    ``dropped`` tells texts of which more than ``coverage`` is hit, whose ``kept_text`` is null."""
    long = F.filter("spans", lambda s: s["end"] - s["start"] >= min_words)

    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        left = []
        for value, first, last in zip(texts, starts, ends):
            value = text_of(value)
            if len(first):
                at = [m.span() for m in _WORDS.finditer(value)]
                pieces, done = [], 0
                for a, b in zip(first, last):
                    pieces.append(value[done : at[a][0]])
                    done = at[b - 1][1]
                value = "".join([*pieces, value[done:]])
            left.append(value)
        return pd.Series(left)

    cut_out = F.pandas_udf(cut, "string")
    dropped = F.col("n_hit") > F.lit(coverage) * F.col("n_words")
    kept = cut_out(F.col(text), F.transform(long, lambda s: s["start"]), F.transform(long, lambda s: s["end"]))
    return found.withColumn("dropped", dropped).withColumn("kept_text", F.when(~F.col("dropped"), kept))


def digests(found: DataFrame) -> DataFrame:
    """The result with a hash in place of items and spans."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
