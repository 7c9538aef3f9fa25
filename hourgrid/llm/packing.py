"""Packing of tokenised documents into sequences of fixed length: bounded-space online best fit.

Texts become token ids in one pass that leaves only the description of each piece (document, start, length, checksum).
The descriptions are dealt to tasks evenly, and each task packs its own: it holds a fixed number of open sequences in a
bitset keyed by free space, puts a piece where the least space remains, opens a sequence if none fits, and closes the
fullest one when too many are open. What a task holds does not grow with its input.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from hourgrid.llm.common import arrow_rows, stage

OPEN_SEQUENCES = 4096
#: Pieces packed by one task: enough that its last open sequences hardly matter.
TASK_PIECES = 500_000
#: Runs without white space beyond this length go to the library whose merging is not quadratic.
LONG_RUN = 4096


class Encoder:
    """Token ids of a text by a byte-level vocabulary.

    `vocabulary` is the JSON file of the tokenizer; `ranks` the same vocabulary as ranks, from which the same ids come
    several times faster. Texts that hold one of the file's added tokens are left to the JSON file, which reads them as such.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        self.vocabulary, self.whole = vocabulary, None
        with open(vocabulary, encoding="utf-8") as file:
            self.added = [t["content"] for t in json.load(file).get("added_tokens", ())]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        long = len(text) > LONG_RUN and max(map(len, text.split()), default=0) > LONG_RUN
        if long or any(token in text for token in self.added):
            if self.whole is None:
                self.whole = Tokenizer.from_file(self.vocabulary)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: all full but the first."""
    first = (length - 1) % capacity + 1
    starts = [0, *range(first, length, capacity)]
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], length], strict=True)]


class BestFit:
    """Open sequences by free space. `place` gives (sequence number, offset)."""

    def __init__(self, capacity: int, open_sequences: int):
        self.capacity, self.limit = capacity, open_sequences
        self.bits, self.count, self.made = 0, 0, 0
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        sequence = self.open[free].pop()
        self.count -= 1
        if not self.open[free]:
            self.bits &= ~(1 << free)
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if self.count == self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            self.open[left].append(sequence)
            self.bits |= 1 << left
            self.count += 1
        return sequence, self.capacity - free


def _pieces(schema: pa.Schema, encoder: tuple[str, str, str], capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(*encoder)

        def rows():
            for batch in batches:
                for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                    ids = np.append(encode(text.as_py() or ""), np.uint32(end)).astype("<u4")
                    for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                        yield doc.as_py(), piece, start, length, zlib.crc32(ids[start : start + length].tobytes())

        yield from arrow_rows(rows(), schema)

    return run


def _packed(schema: pa.Schema, capacity: int, open_sequences: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = BestFit(capacity, open_sequences), TaskContext.get().partitionId() << 40
        for batch in batches:
            places = [bins.place(n) for n in batch.column(3).to_pylist()]
            sequences = pa.array([first + s for s, _ in places], pa.int64())
            offsets = pa.array([o for _, o in places], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], sequences, offsets], schema=schema)

    return run


def pack(
    documents: DataFrame,
    encoder: tuple[str, str, str],
    capacity: int = 2048,
    end: int = 0,
    open_sequences: int = OPEN_SEQUENCES,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its text and the end id; only documents longer than `capacity` are cut, and only their first
    piece may be shorter than it. Null and empty texts are the end id alone. Rows are packed as they are: repeated rows
    and rows without doc_id are documents of their own. Other columns are ignored. An empty table gives no rows. Which
    documents meet in a sequence depends on the number of tasks; places within a sequence have no gap or overlap.
    """
    names = ["piece int", "start bigint", "length bigint", "ids_crc32 bigint"]
    kind = documents.schema["doc_id"].dataType
    types = [to_arrow_type(kind), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    columns = ["doc_id", *(x.split()[0] for x in names)]
    first = pa.schema(list(zip(columns, types, strict=True)))
    schema = f"doc_id {kind.simpleString()}, {', '.join(names)}"
    texts = documents.select("doc_id", "text")
    pieces = stage(texts.mapInArrow(_pieces(first, encoder, capacity, end), schema), "pieces")
    tasks = -(-pieces.count() // TASK_PIECES) or 1
    # Dealt by row, not by key, so no document or size can gather in one task; mixed, so that sizes alternate.
    dealt = pieces.repartition(tasks).sortWithinPartitions(F.xxhash64("doc_id", "piece", "ids_crc32"), *columns)
    last = pa.schema([*first, ("sequence_id", pa.int64()), ("offset", pa.int64())])
    out = f"{schema}, sequence_id bigint, offset bigint"
    return dealt.mapInArrow(_packed(last, capacity, open_sequences), out)
