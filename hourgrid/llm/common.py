"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.staging import scratch_path, stage

__all__ = ["WordCodes", "arrow_rows", "column_or_null", "fresh", "mix", "read", "scratch_path", "stage", "text_bytes"]

#: Words kept in a task's word-to-code cache; beyond it the cache starts anew, so memory stays bounded.
CACHE_WORDS = 400_000


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def column_or_null(df: DataFrame, name: str, kind: str):
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """These names, each lengthened until no column of `df` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


class WordCodes(dict):
    """64-bit code of a word, the same in every task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit codes."""
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The values of a binary or string column as bytes, one at a time from its buffers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()


def arrow_rows(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `size` rows each."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
