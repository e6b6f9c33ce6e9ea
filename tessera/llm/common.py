"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path, table_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: bytes.translate table: A-Z to a-z; every byte that is no word byte to a space.
#: Word bytes are 0-9, a-z and all bytes of non-ASCII characters, so splitting the
#: translated bytes gives the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else.

    ``lower`` has a fast path for pure-ASCII strings, where it is the same
    mapping; other texts take ``translate``.
    """
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def id_text(doc_id: Column) -> Column:
    """The id as text; a null id counts as the empty text."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text modulo ``n``."""
    return F.crc32(id_text(doc_id).cast("binary")) % n


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: later steps start
    from the table, so a lost executor never reruns what came before it."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text after lower-casing A-Z."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def batches(rows: Iterator, size: int) -> Iterator[list]:
    """Lists of at most ``size`` items."""
    out: list = []
    for r in rows:
        out.append(r)
        if len(out) >= size:
            yield out
            out = []
    if out:
        yield out


_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from one task to the next. It holds one thing at a time:
    asking for another key releases what was kept, so stages never add up their memory."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def mix64(x: np.ndarray) -> np.ndarray:
    """Bits of unsigned 64-bit integers, mixed one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
