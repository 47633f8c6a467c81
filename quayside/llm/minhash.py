"""N-gram Jaccard join: MinHash banding and exact verification.

Texts are sets of five-word shingles. Texts with equal sets form a class, which
takes part once. Classes that share a band of MinHash values are candidates;
bands and rows are chosen so that a pair at the threshold is found with the
target recall. Candidates are gathered by component. Texts that only share
boilerplate chain up to components as large as the corpus, so a component of over
REFINE classes is taken apart first, without loss: its shingles are ordered by
how many of its classes have them, and two classes at the threshold share one
among their rarest ones, as many as each could lack and one more. Classes that
share none of these are parted, and what stays together is a component anew.

Within a component all pairs that can meet the threshold by size are verified on
their full sets, which each class sends there once (a large component is cut in
tiles of bounded size: its classes are dealt to size steps and blocks, and blocks
meet pairwise). Links are counted where they are verified; only a spanning star
of each tile leaves it.

Words are runs of characters other than ASCII white space, A-Z in lower case. A
text of one to four words is one shingle; texts without words (also null ones)
are equal. Rows with a null id are judged like others.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import mix, process_cache, text_of
from quayside.llm.components import components
from quayside.llm.suffix_tree import words_of
from quayside.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 128
RECALL = 0.999
# Components of more classes than this are taken apart by their rare shingles.
REFINE = 64
# Classes that are verified against each other at once; small components share a task.
TILE = 1024
UNIT_ROWS = 2048


def choose_bands(threshold: float = THRESHOLD, hashes: int = HASHES, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows): the longest bands that find a pair at the threshold with the target recall."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return bands, rows
    return hashes, 1


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < 300_000:
            self[word] = found
        return found


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    held = process_cache("minhash")
    if "words" not in held:
        held["words"] = _Words()
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(held["words"].__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(words) - size + 1)
    value = np.full(n, len(words) if len(words) < size else size, dtype=np.uint64)
    for j in range(min(size, len(words))):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n])
    return np.unique(value)


def set_key(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def signatures(df: DataFrame, threshold: float, hashes: int, recall: float) -> DataFrame:
    """``doc_id, text_hash, key, bands``: the shingle set's key and one hash for each band."""
    bands, rows = choose_bands(threshold, hashes, recall)
    random = np.random.default_rng(20240607)
    factors = random.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    shifts = random.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32)

    def run(frames):
        for frame in frames:
            keys, found = [], []
            for value in frame["text"]:
                values = shingles(text_of(value))
                keys.append(set_key(values))
                least = np.full(bands * rows, 0xFFFFFFFF, dtype=np.uint32)
                folded = (values >> np.uint64(32)).astype(np.uint32) ^ values.astype(np.uint32)
                for a in range(0, len(folded), 4096):
                    np.minimum(least, (folded[a : a + 4096, None] * factors + shifts).min(0), out=least)
                band = np.arange(bands, dtype=np.uint64)
                for r in range(rows):
                    band = mix(band * np.uint64(0x9E3779B97F4A7C15) + least.reshape(bands, rows)[:, r])
                found.append(band.astype(np.int64))
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "text_hash": frame["text_hash"], "key": keys, "bands": found})

    kind = df.schema["doc_id"].dataType
    sent = df.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "text_hash")
    found = sent.mapInPandas(run, "doc_id string, text_hash long, key binary, bands array<long>")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def _candidates(rows: DataFrame) -> DataFrame:
    """``a, b``: each class (``key``) of a bucket and the bucket's first class."""
    full = rows.groupBy("bucket").agg(F.min("key").alias("hub"), F.max("key").alias("_last")).where("hub < _last").drop("_last")
    return rows.join(full, "bucket").where("key != hub").select(F.col("key").alias("a"), F.col("hub").alias("b")).distinct()


def _refined(large: DataFrame, threshold: float) -> DataFrame:
    """``key, root``: members of large components, parted by their rare shingles; those that are left alone are missing.

    Of two sets that meet the threshold each has at least ``threshold`` of itself in
    common with the other. So in any order of shingles, one for both, the first ones
    that each could lack and one more hold a common one. The rarest come first;
    a shingle of one class only links nothing.
    """
    least = round(threshold * 1000)

    def rows(frames):
        for frame in frames:
            for key, root, data in zip(frame["key"], frame["root"], frame["shingles"]):
                values = np.frombuffer(data, dtype=np.uint64)
                n = len(values)
                # Equal shingles of other components are others; a collision could only keep more together.
                buckets = mix(values ^ np.uint64(xxhash.xxh64_intdigest(root))).astype(np.int64)
                for a in range(0, n, 1 << 16):
                    part = buckets[a : a + (1 << 16)]
                    yield pd.DataFrame({"key": [key] * len(part), "first": n + (-least * n // 1000) + 1, "bucket": part})

    sent = large.select("key", "root", "shingles").mapInPandas(rows, "key binary, first long, bucket long")
    shared = sent.groupBy("bucket").agg(F.count("*").alias("_n")).where("_n > 1")
    rarest = Window.partitionBy("key").orderBy(F.coalesce("_n", F.lit(1)), "bucket")
    ordered = sent.join(shared, "bucket", "left").withColumn("_rank", F.row_number().over(rarest))
    firsts = cut_lineage(ordered.where("_n > 1 AND _rank <= first").select("key", "bucket"), "rare-shingles")
    return components(_candidates(firsts)).withColumnRenamed("node", "key")


def _placed(members: DataFrame, threshold: float) -> DataFrame:
    """Members with the units in which they are verified: ``unit`` and the ``side`` that they are on.

    A small component is a part of one unit (side 0, compared within its
    component). A large one is cut by size step, at most one of which lies between
    texts that meet the threshold, and by block of TILE classes.
    """
    step = math.log(1 / threshold)
    sizes = members.groupBy("root").agg(F.count("*").alias("_m"))
    total = members.count()
    units = max(1, -(-total // UNIT_ROWS))
    members = members.join(sizes, "root").withColumn("_step", F.floor(F.log(F.greatest("n_set", F.lit(1))) / F.lit(step)))
    small = members.where(F.col("_m") <= TILE).select(
        "root", "key", "copies", F.concat(F.lit("u"), F.pmod(F.xxhash64("root"), F.lit(units))).alias("unit"), F.lit(0).alias("side")
    )
    large = members.where(F.col("_m") > TILE)
    cells = large.groupBy("root", "_step").agg(F.ceil(F.count("*") / F.lit(TILE)).cast("long").alias("_blocks"))
    own = large.join(cells, ["root", "_step"]).withColumn("_block", F.pmod(F.xxhash64("key"), F.col("_blocks")))
    above = cells.select("root", (F.col("_step") - 1).alias("_step"), F.col("_blocks").alias("_above"))
    below = cells.select("root", (F.col("_step") + 1).alias("_step"), F.col("_blocks").alias("_below"))
    own = own.join(above, ["root", "_step"], "left").join(below, ["root", "_step"], "left")
    block, at = F.col("_block"), F.col("_step")

    def name(step_a, a, step_b, b):
        return F.concat_ws(":", F.hex("root"), step_a, a, step_b, b)

    def others(count, body):
        last = F.coalesce(count, F.lit(0)) - 1
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0).cast("long"))), body)).otherwise(
            F.array().cast("array<struct<unit:string,side:int>>")
        )

    def place(unit, side):
        return F.struct(unit.alias("unit"), side.cast("int").alias("side"))

    within = others(
        F.col("_blocks"), lambda j: place(name(at, F.least(block, j), at, F.greatest(block, j)), F.when(block > j, 1).otherwise(0))
    )
    up = others(F.col("_above"), lambda j: place(name(at, block, at + 1, j), F.lit(0)))
    down = others(F.col("_below"), lambda j: place(name(at - 1, j, at, block), F.lit(1)))
    placed = own.select("root", "key", "copies", F.explode(F.concat(within, up, down)).alias("_p"))
    return small.union(placed.select("root", "key", "copies", "_p.unit", "_p.side"))


def _similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which of ``left`` and ``right`` (places in ``sets``) have a Jaccard similarity of at least ``threshold``."""
    every = np.concatenate([left, right])
    both = np.concatenate([sets[i] for i in every]) if len(every) else np.zeros(0, dtype=np.uint64)
    values, column = np.unique(both, return_inverse=True)
    sizes = np.array([len(sets[i]) for i in every])
    row = np.repeat(np.arange(len(every)), sizes)
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    # Shingles in one set only are in no intersection.
    use = np.bincount(column, minlength=len(values)) > 1
    rank = np.cumsum(use) - 1
    keep = use[column]
    row, column = row[keep], rank[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for a in range(0, int(use.sum()), 2048):
        lo, hi = np.searchsorted(column, [a, a + 2048])
        dense = np.zeros((len(every), min(2048, int(use.sum()) - a)), dtype=np.float32)
        dense[row[lo:hi], column[lo:hi] - a] = 1
        common += dense[: len(left)] @ dense[len(left) :].T
    union = sizes[: len(left), None] + sizes[None, len(left) :] - common
    # Compared in whole numbers: 0.8 as a float would lose pairs that meet it exactly.
    return common * 1000 >= np.round(threshold * 1000) * union


def _verify(threshold: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        whole = frame["unit"].iat[0].startswith("u")
        for _, part in frame.groupby("root") if whole else [("", frame)]:
            # By key, so that the smallest member of a tile is that of its star.
            part = part.drop_duplicates("key").sort_values("key", ignore_index=True)
            sets = [np.frombuffer(b, dtype=np.uint64) for b in part["shingles"]]
            side, copies = part["side"].to_numpy(), part["copies"].to_numpy()
            cross = not whole and side.any()
            left = np.flatnonzero(side == 0)
            right = np.flatnonzero(side == 1) if cross else left
            linked = _similar(sets, left, right, threshold)
            if not cross:
                np.fill_diagonal(linked, False)
            links = np.zeros(len(part), dtype=np.int64)
            links[left] += linked @ copies[right]
            if cross:
                links[right] += linked.T @ copies[left]
            # The smallest member that each reaches within the tile.
            label = np.arange(len(part))
            while True:
                before = label.copy()
                best = np.where(linked, label[right][None, :], len(part)).min(1, initial=len(part))
                label[left] = np.minimum(label[left], best)
                best = np.where(linked, label[left][:, None], len(part)).min(0, initial=len(part))
                label[right] = np.minimum(label[right], best)
                label = label[label]
                if (label == before).all():
                    break
            keys = part["key"].to_numpy()
            out.append(pd.DataFrame({"key": keys, "hub": keys[label], "links": links}))
        return pd.concat(out)

    return run


def near_duplicates(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    hashes: int = HASHES,
    recall: float = RECALL,
) -> DataFrame:
    """One row per document: ``doc_id, text_hash, group, class_id, n_links, n_copies``.

    ``class_id`` is the smallest id of all documents that it is linked with, also
    through others; ``n_links`` counts the other documents at or above the
    threshold, ``n_copies`` those among them, and itself, with an equal shingle set.
    ``group`` names the linked documents also where ids are null.
    """
    given = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))
    signed = cut_lineage(signatures(given, threshold, hashes, recall), "signatures")
    classes = signed.groupBy("key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("r"), F.count("*").alias("copies"), F.any_value("bands").alias("bands"), F.min("doc_id").alias("least")
    )
    classes = cut_lineage(classes.select("key", "r.doc_id", "r.text_hash", "copies", "bands", "least"), "classes")
    found = components(_candidates(classes.select("key", F.explode("bands").alias("bucket"))))
    found = found.join(found.groupBy("root").agg(F.count("*").alias("members")), "root")
    members = found.withColumnRenamed("node", "key").join(
        classes.select("key", F.col("doc_id").alias("rep"), "text_hash", "copies"), "key"
    )
    texts = given.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "text")
    joined = members.join(texts, F.col("rep").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))

    def sets(frames):
        for frame in frames:
            out = frame.drop(columns="text")
            values = [shingles(text_of(t)) for t in frame["text"]]
            out["n_set"] = [len(v) for v in values]
            out["shingles"] = [v.tobytes() for v in values]
            yield out

    with_sets = joined.select("key", "root", "members", "copies", "text").mapInPandas(
        sets, "key binary, root binary, members long, copies long, n_set long, shingles binary"
    )
    with_sets = cut_lineage(with_sets.dropDuplicates(["key"]), "sets")
    sized = with_sets.select("key", "root", "members", "copies", "n_set")
    parted = _refined(with_sets.where(F.col("members") > REFINE), threshold)
    parted = sized.select("key", "copies", "n_set").join(parted, "key")
    sized = sized.where(F.col("members") <= REFINE).select("key", "root", "copies", "n_set").unionByName(parted)
    units = _placed(cut_lineage(sized, "members"), threshold).select("unit", "side", "key", "root", "copies")
    verified = cut_lineage(
        units.join(with_sets.select("key", "shingles"), "key")
        .groupBy("unit")
        .applyInPandas(_verify(threshold), "key binary, hub binary, links long"),
        "verified",
    )
    links = verified.groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(verified.select(F.col("key").alias("a"), F.col("hub").alias("b")))
    grouped = groups.join(classes.select(F.col("key").alias("node"), "least"), "node")
    smallest = grouped.groupBy("root").agg(F.min("least").alias("smallest"))
    grouped = grouped.join(smallest, "root").select(F.col("node").alias("key"), "root", "smallest")
    judged = (
        classes.select("key", "copies", "least")
        .join(links, "key", "left")
        .join(grouped, "key", "left")
        .select(
            "key", F.hex(F.coalesce("root", "key")).alias("group"), F.coalesce("smallest", "least").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("n_copies"),
        )
    )
    return signed.select("doc_id", "text_hash", "key").join(judged, "key").select("doc_id", "text_hash", "group", "class_id", "n_links", "n_copies")
