"""Document fingerprints from closed syncmers, in DataFrame functions only.

The symbols of a text are its words (runs without ASCII white space; a word of
over LONG characters is cut in parts of LONG). A k-mer is K words in a row, and is
chosen if the least hash of its S-word substrings is that of the first or of the
last one. Whether a k-mer is chosen depends on nothing outside it, so texts that
share a passage share its anchors, wherever it stands. A text of fewer than K
words has one anchor, all its words.

The fingerprint holds every distinct anchor (40 bits of its hash) with the first
place where it stands, sorted by hash, in hexadecimal. Two fingerprints are matched
by place: their likeness is the Jaccard similarity of their anchors, halved by as
much as the order of the shared anchors disagrees (Spearman's footrule of their
ranks over its greatest value). So equal texts are alike (1), a text whose
passages stand in another order is less alike, and a short passage that long texts
share counts for its share. Two texts without words are alike, one without words is
unlike any other (0). Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.llm.common import SPACES, let

K = 5
S = 2
LONG = 32
# Rows of one neighbourhood when documents are put in order, and the most neighbourhoods.
NEIGHBOURS = 1024
MOST_NEIGHBOURHOODS = 4096


def words(text: Column) -> Column:
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    found = F.filter(F.split(spaced, " "), lambda w: w != "")
    return let(
        found,
        lambda ws: F.when(
            F.exists(ws, lambda w: F.length(w) > LONG),
            F.flatten(F.transform(ws, lambda w: F.regexp_extract_all(w, F.lit(f"(?s).{{1,{LONG}}}"), F.lit(0)))),
        ).otherwise(ws),
    )


def anchors(text: Column) -> Column:
    """Array of (hash, place) of the text's closed syncmers; places count words from 0."""

    def chosen(h: Column) -> Column:
        n = F.size(h)
        inner = F.transform(F.sequence(F.lit(0), n - S), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(S)]))
        last = K - S

        def at(s: Column) -> Column:
            closed = F.filter(
                F.sequence(F.lit(0), n - K),
                lambda i: F.least(F.get(s, i), F.get(s, i + last)) <= F.least(*[F.get(s, i + j) for j in range(1, last)]),
            )
            return F.transform(
                closed, lambda i: F.struct(F.xxhash64(*[F.get(h, i + j) for j in range(K)]).alias("hash"), i.alias("place"))
            )

        whole = F.struct(F.aggregate(h, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x)).alias("hash"), F.lit(0).alias("place"))
        none = F.array().cast("array<struct<hash:bigint,place:int>>")
        return F.when(n >= K, let(inner, at)).when(n > 0, F.array(whole)).otherwise(none)

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), chosen)


def sketch(text: Column) -> Column:
    """Distinct anchors, ``hash`` (40 bits) and first ``place``, sorted by hash."""
    short = F.transform(anchors(text), lambda a: F.struct(F.shiftrightunsigned(a["hash"], 24).alias("hash"), a["place"].alias("place")))
    return let(F.sort_array(short), lambda s: F.filter(s, lambda x, i: (i == 0) | (F.get(s, i - 1)["hash"] != x["hash"])))


def fingerprint(sketched: Column) -> Column:
    return F.concat_ws(" ", F.transform(sketched, lambda a: F.concat_ws(":", F.lower(F.hex(a["hash"])), F.lower(F.hex(a["place"])))))


def _matched(one: Column, two: Column) -> Column:
    """Places of the shared anchors, in the first text (``a``) and in the second (``b``), by ``a``."""

    def side(of: Column, number: int) -> Column:
        return F.transform(of, lambda a: F.struct(a["hash"].alias("hash"), F.lit(number).alias("side"), a["place"].alias("place")))

    # In hash order a shared anchor stands beside its match, since neither side repeats one.
    both = F.sort_array(
        F.concat(side(one, 0), side(two, 1))
    )
    return let(
        F.transform(both, lambda x: F.struct(x["hash"].alias("hash"), x["place"].alias("place"))),
        lambda m: F.sort_array(
            F.filter(
                F.transform(
                    m,
                    lambda x, i: F.when(
                        (i > 0) & (F.get(m, i - 1)["hash"] == x["hash"]),
                        F.struct(F.get(m, i - 1)["place"].alias("a"), x["place"].alias("b")),
                    ),
                ),
                lambda x: x.isNotNull(),
            )
        ),
    )


def likeness(one: Column, two: Column) -> Column:
    def judged(pairs: Column) -> Column:
        n = F.size(pairs).cast("long")
        every = F.size(one) + F.size(two) - n
        by_second = F.sort_array(F.transform(pairs, lambda x, i: F.struct(x["b"].alias("b"), i.alias("rank"))))
        moved = F.transform(by_second, lambda x, i: F.abs(x["rank"] - i).cast("long"))
        apart = F.aggregate(moved, F.lit(0).cast("long"), lambda s, x: s + x)
        disorder = F.when(n > 1, apart / F.floor(n * n / 2)).otherwise(F.lit(0.0))
        return F.when(every == 0, F.lit(1.0)).otherwise(n / every * (1 - disorder / 2))

    return let(_matched(one, two), judged)


def document_anchors(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per anchor, ``doc_id, hash, place``, for positional matching of documents."""
    return df.select(F.col(doc_id).alias("doc_id"), F.explode(anchors(F.col(text))).alias("a")).select("doc_id", "a.hash", "a.place")


def with_next(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` (``doc_id`` a number, ``text``, ``columns``) with ``next``: ``columns`` of the next row by descending id.

    After the last row comes the first. Equal ids are ordered by the hash of
    their text and the text; null ids are the smallest. Rows are dealt to
    neighbourhoods by quantiles of the id, an id that fills several by the hash of
    the text; only the last row of each neighbourhood crosses to the one after it.
    """
    rows = df.count()
    pieces = max(1, min(MOST_NEIGHBOURHOODS, -(-rows // NEIGHBOURS)))
    df = df.withColumn("_hash", F.xxhash64("text"))
    cuts = []
    if pieces > 1:
        shares = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
        cuts = df.agg(F.percentile_approx("doc_id", shares, 10 * pieces).alias("q")).first().q or []
    if cuts:
        held = F.array(*[F.lit(c) for c in cuts])
        below = F.size(F.filter(held, lambda c: c < F.col("doc_id")))
        equal = F.size(F.filter(held, lambda c: c == F.col("doc_id")))
        spread = F.col("_hash") / F.lit(2.0**64) + 0.5
        piece = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(below + F.floor(spread * equal).cast("int"))
    else:
        piece = F.lit(0)
    placed = df.withColumn("_piece", piece)
    value = F.struct(*columns)
    ends = placed.groupBy("_piece").agg(F.max_by(value, F.struct("doc_id", "_hash", "text")).alias("_value"))
    # At most MOST_NEIGHBOURHOODS rows.
    follow = Window.orderBy("_piece")
    order = ends.select("_piece").withColumn("_to", F.lead("_piece").over(follow))
    order = order.withColumn("_to", F.coalesce("_to", F.min("_piece").over(Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    crossing = ends.join(order, "_piece").select(F.col("_to").alias("_piece"), "_value")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in placed.schema if f.name != "_piece"]
    crossing = crossing.select(*empty, "_piece", F.lit(True).alias("_crossing"), "_value")
    names = [c for c in placed.columns if c != "_piece"]
    every = placed.select(*names, "_piece", F.lit(False).alias("_crossing"), value.alias("_value")).unionByName(crossing)
    within = Window.partitionBy("_piece").orderBy(F.col("_crossing").desc(), "doc_id", "_hash", "text")
    return every.withColumn("next", F.lag("_value").over(within)).where("NOT _crossing").drop("_crossing", "_value", "_piece", "_hash")


def edited(text: Column, following: Column) -> Column:
    """The text with its last third replaced by as many first characters of the following one, or all."""
    return let(
        F.struct(F.coalesce(text, F.lit("")).alias("t"), F.coalesce(following, F.lit("")).alias("f")),
        lambda x: F.concat(
            F.left(x["t"], F.length(x["t"]) - F.floor(F.length(x["t"]) / 3).cast("int")),
            F.left(x["f"], F.floor(F.length(x["t"]) / 3).cast("int")),
        ),
    )


def fingerprint_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how like it is to that and to the next document."""
    own = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Only texts are shuffled: anchors take more room, and are made again for the next text.
    paired = with_next(own, ["text"])
    changed = paired.select("doc_id", "text", F.col("next.text").alias("next_text"), edited(F.col("text"), F.col("next.text")).alias("edited"))
    changed = changed.withColumns({"sketch": sketch(F.col("text")), "next_sketch": sketch(F.col("next_text")), "edited_sketch": sketch(F.col("edited"))})
    return changed.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
