"""Fill-in-middle: documents cut in prefix, middle and suffix and put together anew.

A text is cut into units, runs of ASCII letters or single other characters. The
hash of the document's id gives two cuts between units and the form: ``plain`` (the
text as it is), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle),
each piece behind its marker. Texts that hold a marker stay plain, so that an output
can be taken apart again without doubt (``restored``).

Whole columns go through ``pyarrow.compute``, no row through Python: units are split
into list arrays, flattened with the index of their row, numbered within it, filtered
by role, rebuilt as lists and joined. A unit ends at SEPARATOR; what a text has of
that character and of ESCAPE is written as two characters first, so that any text is
cut exactly.

A null text counts as empty: no units, plain. A null id is hashed as no digits. Repeated
rows give equal rows, an empty table an empty one; other columns are not read but for
those asked for by ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The markers of the three pieces.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKED = "<[PSM]>"
# Of 100 documents, 90 are cut up, of those 20 in the order suffix, prefix, middle.
CUT_SHARE, SPM_SHARE = 90, 20
SEPARATOR, ESCAPE = "\x1f", "\x1e"
ESCAPED_SEPARATOR, ESCAPED_ESCAPE = ESCAPE + "S", ESCAPE + "E"
UNIT = rf"\x1e[SE]|[A-Za-z]+|[^A-Za-z]"
# Characters of the texts that are split at once; a longer text is split alone.
CHUNK = 4_000_000


def hashes(doc_id: Column) -> list[Column]:
    """The first four 32-bit numbers of the hash of a document's id."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def split_units(texts: pa.Array) -> pa.Array:
    """Units of each text as lists, with an empty one at the end of each."""
    escaped = pc.replace_substring(texts, ESCAPE, ESCAPED_ESCAPE)
    escaped = pc.replace_substring(escaped, SEPARATOR, ESCAPED_SEPARATOR)
    ended = pc.replace_substring_regex(escaped, UNIT, rf"\0{SEPARATOR}")
    return pc.split_pattern(ended, SEPARATOR)


def join_units(units: pa.Array, counts: pa.Array) -> pa.Array:
    """``counts`` units after one another as one text each."""
    ends = pc.cumulative_sum(pc.cast(counts, pa.int32()))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, units), pa.scalar("", units.type))
    plain = pc.replace_substring(joined, ESCAPED_SEPARATOR, SEPARATOR)
    return pc.replace_substring(plain, ESCAPED_ESCAPE, ESCAPE)


def _modulo(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def transform(texts: pa.Array, h: list[pa.Array]) -> dict[str, pa.Array]:
    """Columns of the result for texts and the four hashes of their ids."""
    units = split_units(texts)
    lengths = pc.cast(pc.list_value_length(units), pa.int64())
    n = pc.subtract(lengths, 1)
    cuts = [_modulo(h[0], lengths), _modulo(h[1], lengths)]
    first, second = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)

    parents = pc.list_parent_indices(units)
    flat = pc.list_flatten(units)
    starts = pc.subtract(pc.cumulative_sum(lengths), lengths)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(starts, parents))
    before_middle = pc.less(ordinal, pc.take(first, parents))
    before_suffix = pc.less(ordinal, pc.take(second, parents))
    roles = (before_middle, pc.and_not(before_suffix, before_middle), pc.invert(before_suffix))
    counts = (first, pc.subtract(second, first), pc.subtract(lengths, second))
    prefix, middle, suffix = (join_units(pc.filter(flat, role), count) for role, count in zip(roles, counts))

    plain = pc.or_(pc.equal(n, 0), pc.match_substring_regex(texts, MARKED))
    plain = pc.or_(plain, pc.greater_equal(_modulo(h[2], pa.scalar(100)), CUT_SHARE))
    spm = pc.less(_modulo(h[3], pa.scalar(100)), SPM_SHARE)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))

    def together(*parts):
        return pc.binary_join_element_wise(*[p if isinstance(p, pa.Array) else pa.scalar(p, texts.type) for p in parts], pa.scalar("", texts.type))

    psm_text = together(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    spm_text = together(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    cut = pc.invert(plain)

    def chars(piece):
        return pc.if_else(cut, pc.cast(pc.utf8_length(piece), pa.int64()), pa.scalar(None, pa.int64()))

    output = pc.if_else(plain, texts, pc.if_else(spm, spm_text, psm_text))
    return {"n": n, "form": form, "prefix_chars": chars(prefix), "middle_chars": chars(middle), "output": output}


def chunks(lengths: np.ndarray, limit: int = CHUNK):
    """Row ranges of at most ``limit`` characters together, or one row."""
    start, held = 0, 0
    for i, length in enumerate(lengths):
        if i > start and held + length > limit:
            yield start, i
            start, held = i, 0
        held += int(length)
    if start < len(lengths):
        yield start, len(lengths)


def fill_in_middle(docs: DataFrame, keep: list[str] = ("doc_id",), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``keep`` with ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text."""
    kept = [f"_k{i}" for i in range(len(keep))]
    asked = docs.select(
        *[F.col(c).alias(k) for c, k in zip(keep, kept)],
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        *[h.alias(f"_h{i}") for i, h in enumerate(hashes(F.col(doc_id)))],
    )

    def run(batches):
        for batch in batches:
            sizes = np.diff(np.frombuffer(batch["_text"].cast(pa.large_string()).buffers()[1], np.int64)[: len(batch) + 1]) if len(batch) else []
            for a, b in chunks(sizes):
                part = batch.slice(a, b - a)
                made = transform(part["_text"].cast(pa.large_string()), [part[f"_h{i}"] for i in range(4)])
                made["output"], made["form"] = made["output"].cast(pa.string()), made["form"].cast(pa.string())
                yield pa.RecordBatch.from_arrays([*(part[k] for k in kept), *made.values()], names=[*kept, *made])

    own = asked.select(*kept).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.fields)
    result = asked.mapInArrow(run, f"{schema}, n long, form string, prefix_chars long, middle_chars long, output string")
    return result.withColumnsRenamed(dict(zip(kept, keep)))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. No piece holds a marker, so cutting at them is exact."""
    parts = F.split(output, MARKED, -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def digests(made: DataFrame) -> DataFrame:
    """The result with hashes in place of texts."""

    def sha(value: Column) -> Column:
        return F.sha2(value.cast("binary"), 256)

    return made.withColumns(
        {"output_sha256": sha(F.col("output")), "restored_sha256": sha(restored(F.col("output"), F.col("form")))}
    ).drop("output")
