"""Language-model scores from a probabilistic suffix tree.

Symbols are the words of the training texts, the end of a text, and one symbol
for all unknown words, as in the base score. A state is the longest suffix of the
words before (up to DEPTH) that the tree holds. A context is in the tree if
training texts hold it at least twice and its next words diverge from what its
own suffix predicts by more than its parameters cost. Next-word distributions
are mixed with those of the suffix (Witten and Bell) down to the root, whose
counts are discounted by what unknown words need (absolute discounting). So the
probabilities of all symbols add up to one in every state.

SEEN is a count, not a share of the corpus, so the tree grows with it: what was seen
once only is its own evidence and is left to the back-off, whatever the corpus. Nothing of the tree is
collected but the sums of heavy contexts, of which there are at most HEAVY in any corpus.

Words, contexts and next words are counted level by level. Each window of WINDOW rows
of an input partition sends its distinct words, gets their counts and numbers of the whole corpus back,
and is written once by these numbers, so that no later pass splits texts. From then on it sends the distinct
n-grams of its texts, as arrays dealt by their context (those of heavy contexts by themselves),
and gets the counts of the whole corpus back in the order in which it sent them. An n-gram is
asked for only if its context was seen twice. Words are compared as bytes and then by their numbers,
contexts by 64-bit hashes.

Null texts count as empty: one token, the end. Without training rows all counts
are 0, and the root gives each token probability 1 / (V + 1) = 1.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import encode, remainder
from quayside.llm.common import mix as mixed
from quayside.session import cut_lineage, settings

DEPTH = 3
# How often a context, a next word of it, or a known word before others occurs at least.
SEEN = 2
# Rows of an input partition that are asked for together: a power of two.
WINDOW = 1 << 11
# Next words of contexts that make up more than 1 / HEAVY of all tokens are dealt one by one.
HEAVY = 1 << 12
# What a context must save per next word, in natural units, to be in the tree.
DIVERGENCE = 3.0
MODULUS, HELD_OUT = 7, 2
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
# The end token; no word is empty. It also stands before the first word, as a context.
LAST = b""
LAST_KEY, OTHER_KEY = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
# Numbers of all words that training texts hold less than SEEN times, and of next words that occur once after a context.
SYMBOLS = [0, 1]
# Chances without a level go to its test as -log in steps of 1 / STEPS, in 24 bits; the last two numbers stand for the latter two symbols.
STEPS = 1 << 18
LONE, OTHER = (1 << 24) - 2, (1 << 24) - 1
CHUNK_BYTES = 1 << 20
# Shuffled files of a written level are not needed again.
CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
WORDS = "window long, bucket int, counts binary, counts_large array<long>, numbers array<int>, sums array<long>"
CODED = "window long, ids array<string>, sizes array<long>, known long, codes binary, numbers binary, counts binary, sums array<long>"
ASKED = (
    "window long, bucket int, steps array<int>, steps_middle array<short>, steps_high array<short>, sizes array<int>, "
    "words array<short>, words_middle array<tinyint>, words_high array<int>, n binary, n_large array<long>, "
    "lower array<short>, finer array<tinyint>"
)
ANSWERS = (
    "window long, bucket int, counts binary, counts_large array<long>, over binary, over_large array<long>, "
    "rest binary, rest_large array<long>, contexts array<long>, sums array<long>, lowers array<double>"
)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * LAST_KEY)


def words_of(text: str) -> list[bytes]:
    """Words in bytes, A-Z in lower case."""
    return WORD.findall(encode(text).lower())


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)


def _runs(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and names of runs of equal values."""
    starts = _changes(names)
    return np.diff(np.append(starts, len(names))), names[starts]


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of mixed hashes; larger hashes are in no smaller bucket."""
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _sorted(codes: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of at most ``largest`` in order, and their places."""
    bits = len(codes).bit_length()
    if int(largest).bit_length() + bits < 63:
        # Sorting numbers that hold their place is much faster than sorting places.
        both = codes << bits
        both |= np.arange(len(codes))
        both.sort()
        places = both & ((1 << bits) - 1)
        both >>= bits
        return both, places
    order = np.argsort(codes, kind="stable")
    return codes[order], order


def _changes(*columns: np.ndarray) -> np.ndarray:
    """The rows that differ from the one before."""
    out = np.zeros(len(columns[0]), dtype=bool)
    out[:1] = True
    for values in columns:
        out[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(out)


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(_offsets(sizes)), values)


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return lists.value_lengths().to_numpy()


def _split(data: bytes, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts in lower-case bytes: their distinct words, the number of each word in these, and each text's number of words."""
    texts = pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
    found = pa.compute.ascii_split_whitespace(texts)
    words, sizes = found.flatten(), _sizes(found).astype(np.int64)
    # White space before the first word or after the last one leaves an empty word.
    real = pa.compute.binary_length(words).to_numpy() > 0
    if not real.all():
        ends = np.concatenate([[0], np.cumsum(real)])
        words, sizes = words.filter(pa.array(real)), np.diff(ends[_offsets(sizes)])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), sizes


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words that are not empty."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1]
    chars = np.frombuffer(words.buffers()[2], dtype=np.uint8)
    sizes, out = np.diff(offsets), []
    odd = mixed(np.arange(1, int(sizes.max()) + 1, dtype=np.uint64) * OTHER_KEY) | np.uint64(1)
    a = 0
    while a < len(words):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, "right")) - 1)
        starts = offsets[a:b] - offsets[a]
        place = np.arange(offsets[b] - offsets[a]) - np.repeat(starts, sizes[a:b])
        out.append(np.add.reduceat(_BYTES[chars[offsets[a] : offsets[b]]] * odd[place], starts))
        a = b
    return np.concatenate(out)


def _stretches(batches):
    """``window, ids, sizes, texts`` of each window, the texts on end in bytes; the rows of a window follow one another."""

    def joined(window, parts):
        texts = pa.chunked_array([p.column("text") for p in parts]).combine_chunks().cast(pa.large_binary()).fill_null(b"")
        ids = pa.concat_arrays([p.column("doc_id") for p in parts])
        sizes = pa.compute.binary_length(texts).cast(pa.int64())
        begin = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset]
        data = texts.buffers()[2]
        return window, ids, sizes, data[begin : begin + int(sizes.to_numpy().sum())].to_pybytes() if data else b""

    at, held = None, []
    for batch in batches:
        sizes, names = _runs(batch.column("window").to_numpy())
        start = 0
        for size, name in zip(sizes.tolist(), names.tolist()):
            if held and name != at:
                yield joined(at, held)
                held = []
            at = name
            held.append(batch.slice(start, size))
            start += size
    if held:
        yield joined(at, held)


def _windows(batches):
    """The same as rows, the texts compressed."""
    for window, ids, sizes, texts in _stretches(batches):
        one, blob = np.array([len(ids)]), pa.compress(texts, codec="zstd", asbytes=True)
        yield pa.record_batch({"window": [window], "ids": _lists(ids, one), "sizes": _lists(sizes, one), "texts": pa.array([blob], pa.binary())})


def _held(ids: pa.Array) -> np.ndarray:
    return np.array([remainder(d, MODULUS) == HELD_OUT for d in ids.to_pylist()])


def _pressed(values: np.ndarray) -> bytes:
    """Numbers compressed: the first byte of each, then the second one, and so on."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def _opened(data: bytes, size: int, kind) -> np.ndarray:
    """The numbers of `_pressed`."""
    width = np.dtype(kind).itemsize
    planes = pa.decompress(data, decompressed_size=size * width, codec="zstd", asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(width, size).T).view(kind).ravel()


def _packed(values: np.ndarray, sizes: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """A row of bytes per size, 255 for what is larger, and the larger values."""
    small = np.minimum(values, 255).astype(np.uint8)
    many = np.concatenate([[0], np.cumsum(small == 255)])
    offsets = _offsets(sizes)
    large = pa.ListArray.from_arrays(pa.array(many[offsets].astype(np.int32)), pa.array(values[small == 255]))
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(small)]), large


def _unpack(answers: pa.Table, name: str, size: int) -> np.ndarray:
    """The values of `_packed` of all rows, one row after another."""
    values = np.frombuffer(b"".join(answers[name].to_pylist()), dtype=np.uint8).astype(np.int64)
    if len(values) != size:
        raise ValueError("a word without an answer: the passes over the input read different rows")
    if size:
        values[values == 255] = answers[f"{name}_large"].combine_chunks().flatten().to_numpy()
    return values


def _answers(rows: pa.Table, asked: dict, contexts: np.ndarray, sums: np.ndarray, lowers: np.ndarray) -> pa.Table:
    """Rows of ANSWERS: what each window has asked for, and one of no window for the sums of the bucket."""
    size, bucket = rows.num_rows, rows["bucket"].combine_chunks()
    columns = {"window": rows["window"].combine_chunks(), "bucket": bucket}
    none = np.zeros(size, dtype=np.int64)
    for name in ("counts", "over", "rest"):
        columns[name], columns[f"{name}_large"] = _packed(*asked.get(name, (np.zeros(0, dtype=np.int64), none)))
    for name, kind in (("contexts", np.int64), ("sums", np.int64), ("lowers", np.float64)):
        columns[name] = _lists(pa.array(np.zeros(0, dtype=kind)), none)
    table = pa.table(columns)
    if not len(sums):
        return table
    empty = _packed(np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64))
    last = {"window": pa.array([-1], pa.int64()), "bucket": bucket[:1]}
    for name in ("counts", "over", "rest"):
        last[name], last[f"{name}_large"] = empty
    for name, value in (("contexts", contexts), ("sums", sums), ("lowers", lowers)):
        last[name] = _lists(pa.array(value), np.array([len(value)]))
    return pa.concat_tables([table, pa.table(last)])


class Tree:
    """The tree of few words in memory: words by number, and for each length the contexts in it.

    An n-gram is coded as (number of its first words as an n-gram) * size + (number of its last word);
    ``grams[k]`` holds the sorted codes of the n-grams of k + 2 words that may be contexts.
    """

    def __init__(self, words: list[bytes]):
        self.ids = {w: i for i, w in enumerate(words)}
        self.size = len(words) + 1
        self.grams: list[np.ndarray] = []
        # For each length: kept, back-off share by context number; codes of (context, word) and their shares.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter((self.ids.get(w, -1) for w in words), dtype=np.int64, count=len(words))

    def contexts(self, numbers: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        """For each token the number of the ``length`` words before it as a context, or -1.

        ``starts``: where texts start; each begins with LAST, which has no context.
        """
        found = numbers
        for k in range(length - 1):
            found = self._lookup(self.grams[k], found, numbers, starts)
        out = np.full(len(numbers), -1, dtype=np.int64)
        out[1:] = found[:-1]
        out[starts] = -1
        return out

    def _lookup(self, codes: np.ndarray, before: np.ndarray, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
        previous = np.full(len(numbers), -1, dtype=np.int64)
        previous[1:] = before[:-1]
        previous[starts] = -1
        both = (previous >= 0) & (numbers >= 0)
        out = np.full(len(numbers), -1, dtype=np.int64)
        if len(codes):
            wanted = previous[both] * self.size + numbers[both]
            at = np.searchsorted(codes, wanted).clip(max=len(codes) - 1)
            out[both] = np.where(codes[at] == wanted, at, -1)
        return out

    def chances(self, numbers: np.ndarray, starts: np.ndarray, root: np.ndarray, deepest: int | None = None) -> np.ndarray:
        """p(token | longest suffix in the tree), from its root probability."""
        chance = root.copy()
        for k, (kept, back, codes, shares) in enumerate(self.levels[:deepest]):
            context = self.contexts(numbers, starts, k + 1)
            at = np.flatnonzero(context >= 0)
            at = at[kept[context[at]]]
            if not len(at):
                continue
            share = np.zeros(len(at))
            if len(codes):
                wanted = context[at] * self.size + numbers[at]
                place = np.searchsorted(codes, wanted).clip(max=len(codes) - 1)
                share = np.where((numbers[at] >= 0) & (codes[place] == wanted), shares[place], 0.0)
            chance[at] = share + back[context[at]] * chance[at]
        return chance

    def add_level(self, counted: pd.DataFrame, lower: np.ndarray, totals: np.ndarray, least: float) -> None:
        """Test the contexts of the next length. ``counted``: sorted codes of (context, word), their counts,
        and the number of each context's next words; ``lower``: the same words' chances without this level."""
        codes, counts = counted["code"].to_numpy(), counted["n"].to_numpy(float)
        kinds = counted["kinds"].to_numpy(float)
        size = len(totals)
        context = codes // self.size
        types = np.zeros(size)
        types[context] = kinds
        shown = np.bincount(context, weights=counts, minlength=size)
        back = (totals - shown + types) / np.maximum(totals + types, 1)
        share = counts / (totals + types)[context]
        gain = np.bincount(context, weights=counts * np.log((share + back[context] * lower) / lower), minlength=size)
        # The words that are left out cost what the back-off takes from them.
        gain += (totals - shown) * np.log(np.maximum(back, 1e-12))
        kept = (gain > DIVERGENCE * np.bincount(context, minlength=size).clip(1)) & (totals > 0)
        self.levels.append((kept, back, codes, share))
        self.grams.append(codes[counts >= least])


class Texts:
    """The words of the texts of one window, ``code`` by their numbers in ``dictionary``; the last number is that of LAST."""

    def __init__(self, ids: pa.Array, sizes: pa.Array, texts: bytes):
        self.ids = ids
        self.dictionary, words, per_text = _split(texts.lower(), _offsets(sizes.to_numpy()))
        # A text's words and LAST.
        self.sizes = per_text + 1
        inner = np.ones(int(self.sizes.sum()), dtype=bool)
        inner[np.cumsum(self.sizes) - 1] = False
        self.code = np.full(len(inner), len(self.dictionary), dtype=np.int32)
        self.code[inner] = words
        self.words = mixed(np.append(_hashes(self.dictionary), LAST_KEY))

    @classmethod
    def of(cls, row: pa.Table) -> Texts:
        """The texts of a row of `_windows`."""
        ids, sizes = (row[c].combine_chunks().flatten() for c in ("ids", "sizes"))
        size = int(sizes.to_numpy().sum())
        return cls(ids, sizes, pa.decompress(row["texts"][0].as_py(), decompressed_size=size, codec="zstd", asbytes=True))

    def word_rows(self, window: int, buckets: int) -> pa.Table:
        """``window, bucket, words, n``: distinct words in bytes and their counts in training texts."""
        if len(np.unique(self.words)) < len(self.words):
            raise ValueError("two words of one hash")
        n = np.bincount(self.code[np.repeat(~_held(self.ids), self.sizes)], minlength=len(self.words))
        bucket, order = self._word_order(buckets)
        sizes, names = _runs(bucket[order])
        values = pa.concat_arrays([self.dictionary.cast(pa.binary()), pa.array([LAST])]).take(pa.array(order))
        return pa.table(
            {"window": np.full(len(names), window), "bucket": names.astype(np.int32), "words": _lists(values, sizes),
             "n": _lists(pa.array(n[order].astype(np.int64)), sizes)}
        )

    def _word_order(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        bucket = _bucket(self.words, buckets)
        return bucket, _sorted(bucket, buckets)[1]

    def coded(self, window: int, answers: pa.Table, buckets: int) -> pa.Table:
        """A row of CODED: the texts by the numbers and counts that all windows have of their words.

        Words that training texts hold SEEN times get a number here in the order of those; after them come all
        that they hold never, all that they hold once, and so on.
        """
        bucket, order = self._word_order(buckets)
        counts, numbers = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
        counts[order] = _unpack(answers, "counts", len(order))
        numbers[order] = answers["numbers"].combine_chunks().flatten().to_numpy()
        numbers = numbers * buckets + bucket + len(SYMBOLS)
        known = np.flatnonzero(counts >= SEEN)
        known = known[np.argsort(numbers[known])]
        here = (len(known) + counts).astype(np.int32)
        here[known] = np.arange(len(known))
        sums = np.sum([x for x in answers["sums"].to_pylist() if x] or [[0] * 4], axis=0)
        one = np.array([1])
        return pa.table(
            {"window": [window], "ids": _lists(self.ids, np.array([len(self.ids)])), "sizes": _lists(pa.array(self.sizes), np.array([len(self.sizes)])),
             "known": [len(known)], "codes": pa.array([_pressed(here[self.code])], pa.binary()),
             "numbers": pa.array([_pressed(np.diff(numbers[known], prepend=0))], pa.binary()),
             "counts": pa.array([_pressed(counts[known])], pa.binary()), "sums": _lists(pa.array(sums.astype(np.int64)), one * len(sums))}
        )


class Asked:
    """What the texts of one window ask for, and its answers so far.

    Tokens are the words between two LAST of each text. ``chance``: the probability of each token by the
    contexts of the levels answered. ``state``: for each token the number of the n-gram up to it that may be a
    context of the next level, or -1; ``keys`` and ``counts``: hashes of these n-grams, and how often training
    texts hold them (0: less than SEEN times, or with a rare word).
    """

    def __init__(self, row: pa.Table, root):
        self.ids, sizes = (row[c].combine_chunks().flatten() for c in ("ids", "sizes"))
        sizes = sizes.to_numpy()
        self.held = _held(self.ids)
        (self.known,), (codes,), (numbers,), (counts,) = (row[c].to_pylist() for c in ("known", "codes", "numbers", "counts"))
        codes = _opened(codes, int(sizes.sum()), np.int32)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        self.real = np.ones(len(codes) + len(sizes), dtype=bool)
        self.real[self.starts] = False
        self.code = np.full(len(self.real), codes[-1], dtype=np.int32)
        self.code[self.real] = codes
        self.train = np.repeat(~self.held, sizes + 1)
        self.counts = _opened(counts, self.known, np.int64)
        self.train_counts = np.append(self.counts, np.arange(SEEN))
        # Of each known word, and after them of SYMBOLS.
        self.numbers = np.append(np.cumsum(_opened(numbers, self.known, np.int64)), SYMBOLS)
        self.names = mixed(self.numbers.astype(np.uint64) + OTHER_KEY)
        self.keys = self.names[: self.known]
        self.chance = root(self.train_counts)[self.code]
        self.state = np.where(self.code < self.known, self.code, np.int32(-1))

    def ask(self, level: int, buckets: int, heavy: int) -> None:
        """The distinct n-grams of a context of ``level`` words and a next word, in the order in which they are sent."""
        before = np.full(len(self.state), -1, dtype=np.int32)
        before[1:] = self.state[:-1]
        at = np.flatnonzero((before >= 0) & self.real)
        before, word = before[at], np.minimum(self.code[at], self.known)
        # Rarer than SEEN without its first word, an n-gram occurs once: each occurrence is a next word of its own.
        lone = (self.state[at] < 0) & (word < self.known)
        word[lone] = self.known + 1
        size = len(self.names)
        if level > 1:
            # With less than SEEN others, no next word can be one that makes up a context.
            use = (self.counts - np.bincount(before[lone & self.train[at]], minlength=len(self.counts)) >= SEEN)[before]
            at, before, word = at[use], before[use], word[use]
        used = np.zeros(len(self.counts), dtype=bool)
        used[before] = True
        used = np.flatnonzero(used)
        # Contexts by hash, so by bucket, and after them the heavy ones.
        used = used[np.argsort(self.keys[used])]
        big = self.counts[used] > heavy
        used = np.concatenate([used[~big], used[big]])
        self.small = len(used) - int(big.sum())
        rank = np.zeros(len(self.counts), dtype=np.int32)
        rank[used] = np.arange(len(used))
        self.at, self.context, self.contexts = at, rank[before], self.keys[used]
        codes, order = _sorted(self.context * np.int64(size) + word, len(used) * size)
        first = _changes(codes)
        codes = codes[first]
        self.own = codes // size
        self.next = codes - self.own * size
        self.gram = np.empty(len(at), dtype=np.int32)
        self.gram[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(at))))
        self.first = order[first]
        self.grams = mixed(self.contexts[self.own] + mixed(self.names ^ np.uint64(level))[self.next])
        # Next words of heavy contexts are dealt by themselves, and sent in the order ``moved``.
        self.apart = int(np.searchsorted(self.own, self.small))
        dealt = _bucket(self.grams[self.apart :], buckets) * len(used) + self.own[self.apart :]
        self.dealt, self.moved = _sorted(dealt, buckets * len(used))
        self.moved += self.apart

    def gram_rows(self, window: int, buckets: int) -> pa.Table:
        sent = lambda values: np.concatenate([values[: self.apart], values[self.moved]])
        n = np.bincount(self.gram[self.train[self.at]], minlength=len(self.grams))
        lower = np.minimum(np.rint(np.log(self.chance[self.at[self.first]]) * -STEPS), LONE - 1).astype(np.uint32)
        lower[self.next == self.known], lower[self.next == self.known + 1] = OTHER, LONE
        lower, numbers = sent(lower), self.numbers[sent(self.next)]
        own = np.concatenate([self.own[: self.apart], self.dealt % max(len(self.contexts), 1)])
        bucket = np.concatenate([_bucket(self.contexts, buckets)[self.own[: self.apart]], buckets + self.dealt // max(len(self.contexts), 1)])
        sizes, names = _runs(bucket)
        counts, counts_large = _packed(sent(n), sizes)
        # One entry per context and bucket.
        entry = _changes(own, bucket)
        contexts, entries = self.contexts[own[entry]], _runs(bucket[entry])[0]
        # The contexts of a bucket grow: each is sent as what it adds to the one before.
        steps = contexts.copy()
        steps[1:] -= contexts[:-1]
        starts = np.cumsum(entries) - entries
        steps[starts] = contexts[starts]
        return pa.table(
            {"window": np.full(len(names), window), "bucket": names.astype(np.int32),
             "steps": _lists(pa.array(steps.astype(np.uint32).view(np.int32)), entries),
             "steps_middle": _lists(pa.array((steps >> np.uint64(32)).astype(np.uint16).view(np.int16)), entries),
             "steps_high": _lists(pa.array((steps >> np.uint64(48)).astype(np.uint16).view(np.int16)), entries),
             "sizes": _lists(pa.array(np.diff(np.append(entry, len(own))).astype(np.int32)), entries),
             "words": _lists(pa.array(numbers.astype(np.uint16).view(np.int16)), sizes),
             "words_middle": _lists(pa.array((numbers >> 16).astype(np.uint8).view(np.int8)), sizes),
             "words_high": _lists(pa.array((numbers >> 24).astype(np.int32)), sizes),
             "n": counts, "n_large": counts_large,
             "lower": _lists(pa.array((lower >> 8).astype(np.uint16).view(np.int16)), sizes),
             "finer": _lists(pa.array(lower.astype(np.uint8).view(np.int8)), sizes)}
        )

    def take(self, answers: pa.Table, large: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        """Take the answers to `ask`. ``large``: sorted heavy contexts, their ``over`` and ``rest``."""
        found = _unpack(answers, "counts", len(self.grams))
        counts = found.copy()
        counts[self.moved] = found[self.apart :]
        over, rest = _unpack(answers, "over", self.small), _unpack(answers, "rest", self.small)
        wanted = self.contexts[self.small :].view(np.int64)
        if len(wanted):
            place = np.searchsorted(large[0], wanted)
            if not len(large[0]) or (large[0][place.clip(max=len(large[0]) - 1)] != wanted).any():
                raise ValueError("a context without an answer: the passes over the input read different rows")
            over, rest = np.concatenate([over, large[1][place]]), np.concatenate([rest, large[2][place]])
        shown = (counts >= SEEN) & (self.next < self.known)
        kept, below = over > 0, np.maximum(over, 1)
        share = np.where(shown & kept[self.own], counts / below[self.own], 0.0)
        back = np.where(kept, rest / below, 1.0)
        self.chance[self.at] = share[self.gram] + back[self.context] * self.chance[self.at]
        self.state = np.full(len(self.state), -1, dtype=np.int32)
        self.state[self.at] = np.where(shown[self.gram], self.gram, np.int32(-1))
        self.keys, self.counts = self.grams, np.where(shown, counts, 0)


def count_words(rows: pa.Table) -> pa.Table:
    """The words of one bucket: their counts over all windows and their numbers there, the most frequent first.

    Each window gets them in the order in which it asked, the first one also the sums of the bucket.
    """
    words, n = rows["words"].combine_chunks(), rows["n"].combine_chunks()
    found = words.flatten().dictionary_encode()
    code = found.indices.to_numpy()
    counts = np.bincount(code, weights=n.flatten().to_numpy(), minlength=len(found.dictionary)).astype(np.int64)
    numbers = np.empty(len(counts), dtype=np.int32)
    numbers[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    # Rare words need no number.
    numbers[counts < SEEN] = 0
    sums = [counts.sum(), (counts > 0).sum(), (counts == 1).sum(), (counts == 2).sum()]
    sizes, first = _sizes(words), np.zeros(rows.num_rows, dtype=np.int64)
    first[0] = len(sums)
    small, large = _packed(counts[code], sizes)
    return pa.table(
        {"window": rows["window"], "bucket": rows["bucket"], "counts": small, "counts_large": large,
         "numbers": _lists(pa.array(numbers[code]), sizes), "sums": _lists(pa.array(np.array(sums, dtype=np.int64)), first)}
    )


def count_grams(buckets: int):
    """The n-grams of one bucket: counts over all windows, and what each context there makes of them.

    Numbers from ``buckets`` on hold next words of heavy contexts, which lie in many buckets: what the sums of those
    need goes to a row of its own: its n-grams seen twice or more, and per context the others as one.
    """

    def count(rows: pa.Table) -> pa.Table:
        steps, words = rows["steps"].combine_chunks(), rows["words"].combine_chunks()
        flat = lambda c, kind: rows[c].combine_chunks().flatten().to_numpy().view(kind).astype(np.uint64)
        contexts = flat("steps", np.uint32) | flat("steps_middle", np.uint16) << np.uint64(32) | flat("steps_high", np.uint16) << np.uint64(48)
        entries, asked_sizes = _sizes(steps).astype(np.int64), _sizes(words).astype(np.int64)
        sums, starts = np.cumsum(contexts), np.cumsum(entries) - entries
        contexts = sums - np.repeat(sums[starts] - contexts[starts], entries)
        entry, names = pd.factorize(contexts)
        of = np.repeat(entry, flat("sizes", np.uint32).astype(np.int64))
        word = flat("words", np.uint16) | flat("words_middle", np.uint8) << np.uint64(16) | flat("words_high", np.uint32) << np.uint64(24)
        span = int(word.max()) + 1
        if span * len(names) < 1 << 63:
            gram, distinct = pd.factorize(of * span + word.astype(np.int64))
        else:
            gram, distinct = pd.factorize(mixed(names[of] + mixed(word)))
        own, lower = np.zeros(len(distinct), dtype=np.int64), np.zeros(len(distinct))
        own[gram], lower[gram] = of, flat("lower", np.uint16) * 256.0 + flat("finer", np.uint8)
        other, lone = lower == OTHER, lower == LONE
        lower = np.exp(lower / -STEPS)
        c = np.bincount(gram, weights=_unpack(rows, "n", len(gram)), minlength=len(distinct))
        kinds = np.where(lone, c, c > 0)
        shown = (c >= SEEN) & ~other & ~lone
        add = lambda what: np.bincount(own, weights=what, minlength=len(names))
        asked = {"counts": (np.where(shown, c, 0).astype(np.int64)[gram], asked_sizes)}
        if rows["bucket"][0].as_py() >= buckets:
            seen, others = add(c * ~shown), add(kinds * ~shown)
            both = [(names.view(np.int64)[own[shown]], c[shown], lower[shown]), (names.view(np.int64), seen, -others)]
            parts = [np.concatenate(x) for x in zip(*both)]
            return _answers(rows, asked, parts[0], parts[1].astype(np.int64), parts[2])
        total, shares = add(c), add(c * shown)
        over, rest = total + add(kinds), total - shares + add(kinds)
        back = rest / np.maximum(over, 1)
        gain = np.zeros(len(c))
        gain[shown] = c[shown] * np.log((c[shown] / over[own[shown]] + back[own[shown]] * lower[shown]) / lower[shown])
        # The words that are left out cost what the back-off takes from them.
        gains = add(gain) + (total - shares) * np.log(np.maximum(back, 1e-12))
        kept = (gains > DIVERGENCE * add(shown).clip(1)) & (total > 0)
        for name, value in (("over", over), ("rest", rest)):
            asked[name] = (np.where(kept, value, 0).astype(np.int64)[entry], entries)
        return _answers(rows, asked, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    return count


def heavy_contexts(answers: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heavy contexts in the tree, from the rows that their buckets left: sorted, with ``over`` and ``rest``; both 0 if not kept.

    A heavy context makes up more than 1 / HEAVY of all training tokens, so there are at most HEAVY of them.
    """
    parts = answers.where("window < 0").selectExpr("inline(arrays_zip(contexts, sums, lowers))")
    parts = parts.toDF("context", "c", "lower").withColumn("shown", F.col("lower") > 0)
    sums = parts.groupBy("context").agg(
        F.sum("c").alias("total"),
        F.sum(F.when(F.col("shown"), 1.0).otherwise(-F.col("lower"))).cast("long").alias("kinds"),
        F.sum(F.when(F.col("shown"), F.col("c")).otherwise(0)).alias("own"),
        F.count_if("shown").alias("words"),
    )
    # Only held-out texts may be left to ask for a context that no other text can bring into the tree: its total is 0.
    over, rest = F.greatest(F.col("total") + F.col("kinds"), F.lit(1)), F.col("total") - F.col("own") + F.col("kinds")
    sums = sums.withColumns({"over": over, "rest": rest, "back": rest / over})
    joined = parts.join(F.broadcast(sums), "context")
    share = F.try_divide(F.col("c") / F.col("over") + F.col("back") * F.col("lower"), F.col("lower"))
    gains = joined.groupBy("context", "total", "own", "words", "over", "rest", "back").agg(
        F.sum(F.when(F.col("shown"), F.col("c") * F.log(share)).otherwise(0.0)).alias("gain")
    )
    gain = F.col("gain") + (F.col("total") - F.col("own")) * F.log(F.greatest("back", F.lit(1e-12)))
    kept = (gain > DIVERGENCE * F.greatest("words", F.lit(1))) & (F.col("total") > 0)
    found = gains.select("context", *[F.when(kept, F.col(c)).otherwise(0).alias(c) for c in ("over", "rest")])
    found = found.toPandas().sort_values("context")
    return tuple(found[c].to_numpy(np.int64) for c in ("context", "over", "rest"))


def score_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its tokens, the unigram base score and the tree's log10 probability.

    A window is a stretch of a partition of the scan, so that all passes must read the same partitions,
    as passes over files do. A word or context without an answer stops the task.
    """
    spark = df.sparkSession
    given = df.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    given = given.withColumn("window", F.shiftright(F.monotonically_increasing_id(), WINDOW.bit_length() - 1))
    buckets = given.count() // WINDOW + 1
    texts = given.mapInArrow(_windows, "window long, ids array<string>, sizes array<long>, texts binary")

    def words(batches):
        for window, ids, sizes, text in _stretches(batches):
            yield from Texts(ids, sizes, text).word_rows(window, buckets).to_batches()

    def coded(own: pa.Table, found: pa.Table) -> pa.Table:
        return Texts.of(own).coded(own["window"][0].as_py(), found.sort_by("bucket"), buckets)

    with settings(spark, CLEANED):
        asked = given.mapInArrow(words, "window long, bucket int, words array<binary>, n array<long>")
        known = asked.groupBy("bucket").applyInArrow(count_words, WORDS)
        texts = texts.groupBy("window").cogroup(known.groupBy("window")).applyInArrow(coded, CODED)
        texts = cut_lineage(texts, "words")
        sums = [F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)) for i in range(4)]
        n, v, ones, twos = texts.agg(*sums).first()
    discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.05

    def root(counts: np.ndarray) -> np.ndarray:
        """Root probabilities by training count; 0 stands for the symbol of unknown words."""
        if not n:
            return np.ones(len(counts))
        return np.where(counts > 0, (counts - discount) / n, discount * v / n)

    levels, large = [], []
    heavy = n // HEAVY

    def answered(own: pa.Table, found: pa.Table | None) -> Asked:
        at = Asked(own, root)
        if large:
            found = found.sort_by([("level", "ascending"), ("bucket", "ascending")])
            level = found["level"].to_numpy()
        for k, sums in enumerate(large, 1):
            at.ask(k, buckets, heavy)
            at.take(found.slice(np.searchsorted(level, k), (level == k).sum()), sums)
        return at

    def joined(function, schema: str) -> DataFrame:
        own, every = texts.drop("sums").groupBy("window"), None
        if not levels:
            return own.applyInArrow(lambda table: function(table, None), schema)
        columns = ["window", "bucket", "counts", "counts_large", "over", "over_large", "rest", "rest_large"]
        for k, answers in enumerate(levels, 1):
            part = answers.where("window >= 0").select(F.lit(k).alias("level"), *columns)
            every = part if every is None else every.unionByName(part)
        return own.cogroup(every.groupBy("window")).applyInArrow(function, schema)

    def grams(own: pa.Table, found: pa.Table | None) -> pa.Table:
        at = answered(own, found)
        at.ask(len(large) + 1, buckets, heavy)
        return at.gram_rows(own["window"][0].as_py(), buckets)

    for _ in range(DEPTH if n else 0):
        with settings(spark, CLEANED):
            asked = joined(grams, ASKED)
            levels.append(cut_lineage(asked.groupBy("bucket").applyInArrow(count_grams(buckets), ANSWERS), "next-words"))
            found = heavy_contexts(levels[-1])
        large.append(found)

    def score(own: pa.Table, found: pa.Table | None) -> pa.Table:
        at = answered(own, found)
        counts = at.train_counts[at.code]
        base = np.log10(counts + 1.0) - np.log10(n + v + 1.0)
        # The LAST before each text is a context, not a token.
        real = at.real.astype(float)
        values = (np.ones(len(real)), counts > 0, base, np.log10(at.chance))
        sums = [np.add.reduceat(x * real, at.starts) for x in values]
        return pa.table(
            {"doc_id": at.ids, "held_out": at.held, "n_tokens": sums[0].astype(np.int64), "n_known": sums[1].astype(np.int64),
             "train_tokens": np.full(len(at.held), n, dtype=np.int64), "base_score": sums[2], "score": sums[3]}
        )

    schema = "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return joined(score, schema).withColumn("doc_id", F.col("doc_id").cast(df.schema[doc_id].dataType))
