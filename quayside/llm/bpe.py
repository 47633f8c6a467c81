"""Byte-level BPE by monoid tree reduction.

A text is cut into matches of the vocabulary's pattern. A long match is encoded
in halves; two neighbouring encodings are joined by encoding a window around the
seam anew and growing it until both its edges are stable. The test of an edge is
exact: byte-pair encoding by ranks gives a token sequence if and only if it
gives each pair of neighbours in it, so tokens outside a window whose two edge
pairs encode to themselves cannot change. Decoding concatenates up the same tree.

A null text counts as empty and has no tokens. Texts are whole; only cached
words are bounded.
"""

from __future__ import annotations

import base64
import hashlib

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import encode, parts_of, process_cache, text_of

# A run of at most so many bytes is a leaf of the tree.
LEAF = 5
# Entries of each cache; a full one starts anew.
CACHED = 150_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


_NONE = 1 << 62


class Codec:
    """Encoder and decoder for one table of ranks and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.leaves: dict[bytes, tuple[int, ...]] = {}
        self.edges: dict[tuple[int, int], bool] = {}

    def leaf(self, piece: bytes) -> tuple[int, ...]:
        """Merge the neighbours of lowest rank, leftmost first, until none is in the table."""
        found = self.leaves.get(piece)
        if found is not None:
            return found
        ranks = self.ranks
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(parts[i] + parts[i + 1], _NONE) for i in range(len(parts) - 1)]
        while pairs and (best := min(pairs)) != _NONE:
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], _NONE)
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], _NONE)
        found = tuple([ranks[p] for p in parts])
        if len(piece) <= 4 * LEAF:
            if len(self.leaves) >= CACHED:
                self.leaves.clear()
            self.leaves[piece] = found
        return found

    def stable(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens encode to themselves."""
        found = self.edges.get((left, right))
        if found is None:
            if len(self.edges) >= CACHED:
                self.edges.clear()
            found = self.leaf(self.bytes_of[left] + self.bytes_of[right]) == (left, right)
            self.edges[left, right] = found
        return found

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of two neighbours together, from their own encodings."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        size = 1
        while True:
            a, b = max(0, len(left) - size), min(len(right), size)
            seam = self.decode(left[a:] + right[:b])
            whole = a == 0 and b == len(right)
            window = self.leaf(seam) if whole or len(seam) <= 8 * LEAF else self.halves(seam)
            if (a == 0 or self.stable(left[a - 1], window[0])) and (b == len(right) or self.stable(window[-1], right[b])):
                return left[:a] + window + right[b:]
            size *= 2

    def halves(self, piece: bytes) -> tuple[int, ...]:
        if len(piece) <= LEAF:
            return self.leaf(piece)
        # Cut at a multiple of a leaf, so that words that start alike share their leaves.
        middle = LEAF * -(-len(piece) // (2 * LEAF))
        return self.join(self.halves(piece[:middle]), self.halves(piece[middle:]))

    def encode_match(self, piece: bytes) -> tuple[int, ...]:
        rank = self.ranks.get(piece)
        return (rank,) if rank is not None else self.halves(piece)

    def encode_text(self, text: str) -> tuple[int, ...]:
        return tuple([i for m in self.pattern.findall(text) for i in self.encode_match(encode(m))])

    def decode(self, ids) -> bytes:
        if len(ids) <= 64:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


class Words(dict):
    """Words seen lately: count of tokens, ids as text, and the bytes that the ids decode to."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, word: str):
        ids = self.codec.encode_text(word)
        found = (len(ids), ",".join(map(str, ids)), self.codec.decode(ids))
        if len(word) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[word] = found
        return found


def encode_documents(
    df: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per document ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids``."""
    given = df.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))

    def run(frames):
        held = process_cache("bpe")
        if (ranks_path, pattern) not in held:
            held[ranks_path, pattern] = Words(Codec(load_ranks(ranks_path), pattern))
        words = held[ranks_path, pattern]
        for frame in frames:
            rows = []
            for value in frame["text"]:
                value = text_of(value)
                found = [words[w] for w in parts_of(value)]
                joined = hashlib.sha256(",".join([f[1] for f in found if f[0]]).encode()).hexdigest()
                decoded = hashlib.sha256(b"".join([f[2] for f in found])).hexdigest()
                row = (sum([f[0] for f in found]), joined, decoded)
                rows.append(row + ([int(i) for f in found for i in f[1].split(",")],) if with_ids else row)
            columns = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
            out = pd.DataFrame(rows, columns=columns)
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out

    schema = "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return given.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast(df.schema[doc_id].dataType))
