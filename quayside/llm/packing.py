"""Hierarchical packing into several context sizes.

A document's tokens are cut into full windows and one tail. Tails are routed to
the smallest context size that holds them and packed size by size, longest
first: a window starts with a tail of its own size, its gap is filled with the
largest shorter tails that fit, and what is then left with a part cut off a
shorter tail. Windows that no shorter tail can fill are completed from one
another; the last one is cut into powers of two. So no sequence needs padding.
Sequences of each size are dealt over steps in turn, so that all steps of a
group have the same mix of sizes.

Packing needs no order between documents: documents are dealt to groups of
about GROUP_ROWS by a number given where they are read, so that equal ids spread
too, and each group is packed in one task. An empty or null text is one piece,
its end token. A null id stays null.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import process_cache, text_of

LENGTH = 1024
TIERS = (1024, 512, 256, 128)
GROUP_ROWS = 8192
STEP_TOKENS = 1 << 16
END = 0
# Fixed value: the pattern of this kind of tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary of a byte-level tokenizer."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokens:
    """Ids of texts as the ``tokenizers`` library gives them.

    A text is encoded whole by the same table of ranks, with ids in the order of
    merges, which is checked. Where the table has another order, or a text holds
    one of the tokenizer's added tokens, the library does it itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        with open(path, encoding="utf-8") as held:
            model = json.load(held)
        vocab, letters = self.tokenizer.get_vocab(with_added_tokens=False), _byte_letters()
        merges = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["model"]["merges"]]
        pre = model.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        self.quick = None
        if plain and model.get("normalizer") is None and all(a < b for a, b in zip(merges, merges[1:])):
            ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in added}
            self.quick = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.quick is None or (self.added and self.added.search(text)):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.quick.encode_ordinary(text)
        # An array takes a list in a third of the time that NumPy needs.
        made = array("H" if self.kind.itemsize == 2 else "I", ids)
        if sys.byteorder == "big":
            made.byteswap()
        return made.tobytes()


class Tails:
    """Pieces by length; the largest that fits is found in a mask of lengths."""

    def __init__(self):
        self.by_length: list[list] = [[] for _ in range(LENGTH + 1)]
        self.mask = 0

    def put(self, row: int, start: int, length: int) -> None:
        if length:
            self.by_length[length].append((row, start, length))
            self.mask |= 1 << length

    def take(self, most: int, least: int = 1):
        """A largest piece of ``least`` to ``most`` tokens, or None."""
        length = (self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1
        if length < least:
            return None
        piece = self.by_length[length].pop()
        if not self.by_length[length]:
            self.mask &= ~(1 << length)
        return piece


def plan(lengths: list[int]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences as (size, pieces); a piece is (tail, its start in the tail, length)."""
    tails, done, open_ones = Tails(), [], []
    for row, length in enumerate(lengths):
        tails.put(row, 0, length)
    for k, tier in enumerate(TIERS):
        shorter = TIERS[k + 1] if k + 1 < len(TIERS) else 0
        while (first := tails.take(tier, shorter + 1)) is not None:
            window, gap = [first], tier - first[2]
            while gap and (piece := tails.take(gap)) is not None:
                window.append(piece)
                gap -= piece[2]
            if gap and (piece := tails.take(shorter)) is not None:
                row, start, length = piece
                window.append((row, start, gap))
                tails.put(row, start + gap, length - gap)
                gap = 0
            (done if not gap else open_ones).append((tier, window))
    # What is still open is made full from one another, as windows of the largest size.
    rest = [piece for _, window in open_ones for piece in window]
    window, gap = [], LENGTH
    for row, start, length in rest:
        while length:
            part = min(gap, length)
            window.append((row, start, part))
            start, length, gap = start + part, length - part, gap - part
            if not gap:
                done.append((LENGTH, window))
                window, gap = [], LENGTH
    size = LENGTH
    while window:
        size //= 2
        if sum(p[2] for p in window) < size:
            continue
        held, taken = 0, []
        while held < size:
            row, start, length = window.pop(0)
            part = min(length, size - held)
            taken.append((row, start, part))
            held += part
            if part < length:
                window.insert(0, (row, start + part, length - part))
        done.append((size, taken))
    return done


def pack(
    df: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per piece: where it comes from, its sequence and place, and if asked for its ids."""
    given = df.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    groups = max(1, -(-given.count() // GROUP_ROWS))

    def cut(frames):
        held = process_cache("tokens")
        if tokenizer_path not in held:
            held[tokenizer_path] = Tokens(tokenizer_path)
        tokens = held[tokenizer_path]
        row = TaskContext.get().partitionId() << 33
        for frame in frames:
            ids, ends, numbers = [], [], []
            for value in frame["text"]:
                whole = tokens.encode(text_of(value)) + np.array([END], dtype=tokens.kind).tobytes()
                ids.append(whole)
                numbers.append(row)
                ends.append(len(whole) // tokens.kind.itemsize)
                row += 1
            spread = (np.array(numbers, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"].to_numpy(), "_row": numbers, "_group": (spread % np.uint64(groups)).astype(np.int64),
                 "doc_tokens": np.array(ends, dtype=np.int64), "_ids": ids}
            )

    def full_first(frames):
        """Full windows need no packing: their checksums are taken here and their ids stay behind."""
        for frame in cut(frames):
            rows = []
            for doc, number, group, total, ids in frame.itertuples(index=False):
                width = len(ids) // total
                full = total - total % LENGTH
                if with_ids:
                    rows.append((doc, number, group, total, 0, [], ids))
                    continue
                sums = [_checksum(ids[i * width : (i + LENGTH) * width], width) for i in range(0, full, LENGTH)]
                rows.append((doc, number, group, total, full, sums, ids[full * width :]))
            yield pd.DataFrame(rows, columns=["doc_id", "_row", "_group", "doc_tokens", "_full", "_sums", "_ids"])

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_row", ignore_index=True)
        out, sequence = [], int(frame["_group"].iat[0]) << 32
        docs, totals, ids = frame["doc_id"], frame["doc_tokens"].tolist(), frame["_ids"].tolist()
        full, widths = frame["_full"].tolist(), []
        for i, sums in enumerate(frame["_sums"]):
            widths.append(len(ids[i]) // (totals[i] - full[i]) if totals[i] > full[i] else 1)
            if with_ids:
                full[i] = totals[i] - totals[i] % LENGTH
                sums = [_checksum(ids[i][a * widths[i] : (a + LENGTH) * widths[i]], widths[i]) for a in range(0, full[i], LENGTH)]
            for k, checksum in enumerate(sums):
                out.append((i, k * LENGTH, LENGTH, checksum, sequence, 0, LENGTH))
                sequence += 1
        for size, window in plan([t - f for t, f in zip(totals, full)]):
            offset = 0
            for i, start, length in window:
                base = full[i] if with_ids else 0
                part = ids[i][(base + start) * widths[i] : (base + start + length) * widths[i]]
                out.append((i, full[i] + start, length, _checksum(part, widths[i]), sequence, offset, size))
                offset += length
            sequence += 1
        made = pd.DataFrame(out, columns=["_i", "start", "length", "ids_crc32", "sequence_id", "offset", "tier"])
        # Steps: the sequences of each size, in turn.
        steps = max(1, -(-sum(totals) // STEP_TOKENS))
        firsts = made[made["offset"] == 0]
        turn = firsts.groupby("tier").cumcount() % steps
        made["step"] = made["sequence_id"].map(dict(zip(firsts["sequence_id"], turn)))
        made["doc_id"] = docs.to_numpy()[made["_i"]]
        made["doc_tokens"] = np.array(totals, dtype=np.int64)[made["_i"]]
        made["group"] = frame["_group"].iat[0]
        if with_ids:
            made["ids"] = [
                np.frombuffer(ids[i][s * widths[i] : (s + n) * widths[i]], dtype=f"<u{widths[i]}").astype(np.int64).tolist()
                for i, s, n in zip(made["_i"], made["start"], made["length"])
            ]
        return made[names]

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "group", "step"]
    schema = "doc_id string, " + ", ".join(f"`{n}` long" for n in names[1:])
    if with_ids:
        names, schema = [*names, "ids"], schema + ", ids array<long>"
    middle = "doc_id string, _row long, _group long, doc_tokens long, _full long, _sums array<long>, _ids binary"
    made = given.mapInPandas(full_first, middle).groupBy("_group").applyInPandas(fill, schema)
    return made.withColumn("doc_id", F.col("doc_id").cast(df.schema[doc_id].dataType))


def _checksum(ids: bytes, width: int) -> int:
    return zlib.crc32(ids if width == 4 else np.frombuffer(ids, dtype=f"<u{width}").astype("<u4").tobytes())
