"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters that separate words (ASCII white space); a fixed value.
SPACES = " \t\n\x0b\x0c\r"


# Rows that a Python worker holds at once; texts may be long.
BATCH_ROWS = "2000"


def bounded(spark: SparkSession) -> SparkSession:
    """The session with small batches for Python workers, unless the user has set a size."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def remainder(doc_id, modulus: int) -> int:
    """crc32 of the id as text, modulo: how rows are held out. -1 for a null id, which is never held out."""
    return zlib.crc32(str(doc_id).encode()) % modulus if isinstance(doc_id, str) else -1


class Passed:
    """Columns on their way through Python: whole numbers go as text, since nulls among them would turn them to floats."""

    def __init__(self, df: DataFrame, names: list[str]):
        fields = df.select(*names).schema.fields
        whole = {f.name for f in fields if f.dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")}
        self.out = [F.col(f.name).cast("string").alias(f.name) if f.name in whole else F.col(f.name) for f in fields]
        self.back = [F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]
        self.schema = ", ".join(f"`{f.name}` {'string' if f.name in whole else f.dataType.simpleString()}" for f in fields)


def remainder_column(doc_id: Column, modulus: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def encode(text: str) -> bytes:
    """UTF-8 bytes; a lone surrogate, which Spark cannot hold, becomes ``?``."""
    return text.encode("utf-8", "replace")


def batches_of(texts, limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts hold at most ``limit`` characters together, or one longer text."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_of(value) -> str:
    """A null text counts as an empty one."""
    return value if isinstance(value, str) else ""


_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_SIGNS = r"!-&(-/:-@\[-`{-~"
# Cuts a text only where a match of the byte-level BPE pattern ends: after Latin
# letters before a sign or space, after signs before Latin letters or space (the
# apostrophe, which may start a contraction, is none of these signs), and around
# spaces as the pattern itself does.
_PARTS = re.compile(
    rf" ?[{_LATIN}]+(?=[\s{_SIGNS}]|\Z)| ?[{_SIGNS}]+(?=[\s{_LATIN}]|\Z)| ?\S+|\s+(?!\S)|\s+"
)
# Separators that Python counts as white space and the pattern does not.
_ODD = re.compile("[\x1c-\x1f]")


def parts_of(text: str) -> list[str]:
    """Parts of a text that can be encoded one by one: whole matches of the pattern, mostly one each."""
    return [text] if _ODD.search(text) else _PARTS.findall(text)


def process_cache(name: str) -> dict:
    """A dictionary that outlives a task as long as Spark reuses its Python worker."""
    held = sys.modules.setdefault("_quayside_cache", types.ModuleType("_quayside_cache"))
    return held.__dict__.setdefault(name, {})
