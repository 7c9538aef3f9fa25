"""Removal of long word passages that an earlier document has as well, by difference-cover anchors.

A window is `window` consecutive words. Every window that also starts in a document with a smaller doc_id is removed.

1. Rows with the same text form a class; one text speaks for it, under the smallest doc_id of the class.
2. Anchors are windows of `window - period + 1` words, hashed only where position modulo `period` is in a difference
   cover. For any two positions the cover has a common shift below `period`, so two equal windows, wherever they
   start, share an anchor at the same place inside. Only anchors that several classes hold go on.
3. Each shared anchor is extended: every window around it is hashed, and the smallest doc_id of each hash decides.
4. One last pass over the texts drops the covered words.

Tasks send hashes in blocks by hash. A block already settles what it can: of a hash that it holds many times, one entry
goes on, so a passage in a third of all documents costs one entry per block and gathers nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import WordCodes, mix, stage, text_bytes

#: Difference covers by period (fixed values): differences of members give every remainder.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
}
HELD_ENTRIES = 600_000
PARTITION_ENTRIES = 2_000_000
#: Class keys (8 bytes) up to this number are broadcast; more are joined by shuffle.
BROADCAST_KEYS = 2_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def period_for(window: int) -> int:
    return max(p for p in COVERS if p == 1 or 100 * p <= 65 * window)


class Windows:
    """Hashes of all windows of a word sequence."""

    def __init__(self) -> None:
        self.codes, self.powers, self.backs = WordCodes(), np.ones(1, np.uint64), np.ones(1, np.uint64)

    def sums(self, words: list[bytes]) -> np.ndarray:
        code, n = self.codes.of(words), len(words)
        if n > len(self.powers):
            self.powers, self.backs = (
                np.multiply.accumulate(np.r_[np.ones(1, np.uint64), np.full(2 * n, x)]) for x in (_BASE, _BACK)
            )
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(code * self.powers[:n], out=total[1:])
        return total

    def at(self, sums: np.ndarray, positions: np.ndarray, length: int) -> np.ndarray:
        return mix((sums[positions + length] - sums[positions]) * self.backs[positions])


def cover_positions(count: int, period: int) -> np.ndarray:
    """Positions below `count` whose remainder is in the cover."""
    every = np.arange(0, count + period, period)[:, None] + np.array(COVERS[period])
    return every[every < count]


class Block:
    """Entries (hash, owner, rank, position) of one task, dealt out by hash."""

    def __init__(self, parts: int):
        self.parts, self.hashes, self.owners, self.positions, self.held = parts, [], [], [], 0

    def add(self, owner: int, rank: int, hashes: np.ndarray, positions: np.ndarray) -> None:
        self.hashes.append(hashes)
        self.positions.append(positions.astype(np.int32))
        self.owners.append((owner, rank))
        self.held += len(hashes)

    def deal(self, settle) -> pa.RecordBatch:
        """`settle` names the entries known to be hits and those that others still need."""
        sizes = [len(x) for x in self.hashes]
        key, position = np.concatenate(self.hashes), np.concatenate(self.positions)
        owner, rank = (np.repeat(np.array(x, np.int64), sizes) for x in zip(*self.owners, strict=True))
        hit, needed = settle(key, owner, rank)
        part = (key % np.uint64(self.parts)).astype(np.int32)
        rows = []
        for chosen, settled in ((needed, False), (hit, True)):
            at = np.flatnonzero(chosen)
            if not len(at):
                continue
            if settled:
                part[at] = self.parts + (owner[at] % self.parts).astype(np.int32)
            at = at[np.argsort(part[at], kind="stable")]
            named, starts = np.unique(part[at], return_index=True)
            for p, s, e in zip(named, starts, [*starts[1:], len(at)], strict=True):
                i = at[s:e]
                # Entries of one document stand together: its key and rank are sent once.
                first = np.flatnonzero(np.r_[True, owner[i][1:] != owner[i][:-1]])
                runs = np.diff(np.r_[first, len(i)]).astype(np.int32)
                blobs = owner[i][first], rank[i][first], runs, position[i], key[i][: 0 if settled else None]
                rows.append((int(p), *(x.tobytes() for x in blobs)))
        self.__init__(self.parts)
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        types = [pa.int32(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=ENTRIES.replace(",", " ").split()[::2]
        )


ENTRIES = "part int, owners binary, ranks binary, runs binary, positions binary, hashes binary"
HITS = "owner bigint, positions binary"
_HITS = pa.schema([("owner", pa.int64()), ("positions", pa.binary())])


def _groups(key: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal keys in order `by`, and the run of each place."""
    ordered = key[by]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    return np.flatnonzero(new), np.cumsum(new) - 1


def shared(key: np.ndarray, owner: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors that several owners hold are hits; one entry of each hash, or all of a hash not shared, goes on."""
    by = np.lexsort((owner, key))
    starts, group = _groups(key, by)
    several = (np.maximum.reduceat(owner[by], starts) != np.minimum.reduceat(owner[by], starts))[group]
    hit, needed = np.zeros(len(key), bool), np.zeros(len(key), bool)
    hit[by[several]] = True
    needed[by] = ~several
    needed[by[starts]] = True
    return hit, needed


def later(key: np.ndarray, owner: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that a smaller rank holds as well are hits; the entries of the smallest rank go on."""
    by = np.lexsort((owner, rank, key))
    starts, group = _groups(key, by)
    above = rank[by] > rank[by][starts][group]
    hit = np.zeros(len(key), bool)
    hit[by[above]] = True
    return hit, ~hit


def _settled(parts: int, settle):
    """The same decision over the entries of all tasks with the same hashes."""

    def run(table: pa.Table) -> pa.Table:
        def joined(name: str, kind) -> np.ndarray:
            return np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])

        runs = joined("runs", np.int32)
        owner, position = np.repeat(joined("owners", np.int64), runs), joined("positions", np.int32)
        if table.column("part")[0].as_py() < parts:
            hit, _ = settle(joined("hashes", np.uint64), owner, np.repeat(joined("ranks", np.int64), runs))
            owner, position = owner[hit], position[hit]
        if not len(owner):
            return _HITS.empty_table()
        by = np.argsort(owner, kind="stable")
        starts, _ = _groups(owner, by)
        cuts = np.r_[starts, len(by)]
        blobs = [position[by[s:e]].tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.Table.from_arrays([pa.array(owner[by[starts]]), pa.array(blobs, pa.binary())], schema=_HITS)

    return run


def _anchors(window: int, parts: int):
    period = period_for(window)
    length = window - period + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, block = Windows(), Block(parts)
        for batch in batches:
            for owner, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                words = text.split() if text else []
                if len(words) < window:
                    continue
                positions = cover_positions(len(words) - length + 1, period)
                block.add(owner, 0, windows.at(windows.sums(words), positions, length), positions)
                if block.held >= HELD_ENTRIES:
                    yield block.deal(shared)
        if block.held:
            yield block.deal(shared)

    return run


def _extended(window: int, parts: int):
    period = period_for(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, block = Windows(), Block(parts)
        for batch in batches:
            owners, ranks, found = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for owner, rank, blobs, text in zip(owners, ranks, found, text_bytes(batch.column(2)), strict=True):
                words = text.split()
                anchors = np.concatenate([np.frombuffer(x, np.int32) for x in blobs])
                around = np.zeros(len(words) + 1, np.int64)
                np.add.at(around, np.maximum(anchors - period + 1, 0), 1)
                np.add.at(around, anchors + 1, -1)
                positions = np.flatnonzero(np.cumsum(around)[: len(words) - window + 1])
                if len(positions):
                    block.add(owner, rank, windows.at(windows.sums(words), positions, window), positions)
                if block.held >= HELD_ENTRIES:
                    yield block.deal(later)
        if block.held:
            yield block.deal(later)

    return run


def covered(count: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Marks of the words inside the windows."""
    steps = np.zeros(count + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return np.cumsum(steps[:-1]) > 0


def _kept(window: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, texts = [], [], []
            rows = zip(text_bytes(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            for text, copy, blobs in rows:
                words = text.split() if text else []
                kept = words
                if copy and len(words) >= window:
                    kept = []
                elif blobs:
                    starts = np.concatenate([np.frombuffer(x, np.int32) for x in blobs])
                    gone = covered(len(words), starts, window)
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                counts.append(len(words))
                removed.append(len(words) - len(kept))
                texts.append(b" ".join(kept).decode())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def remove_repeated_passages(documents: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space); one row per input row.

    Windows are judged on the input, not on what is left. Words are what white space (ASCII) separates. Null and empty
    texts have no words; texts below `window` words stay whole. Rows without doc_id lose nothing but what another
    copy of their own text loses, and remove nothing elsewhere. Of rows with the same doc_id none is smaller. A doc_id is
    a whole number, or text that holds one; other text stops the job. Other columns are ignored. An empty table gives no
    rows.
    """
    documents = documents.select("doc_id", "text")
    key = F.xxhash64("text")
    rows = documents.where("text is not null").select(
        key.alias("owner"), F.col("doc_id").cast("bigint").alias("rank"), F.length("text").alias("chars")
    )
    classes = rows.groupBy("owner").agg(
        F.min("rank").alias("rank"), F.count("*").alias("copies"), F.max("chars").alias("chars")
    )
    classes = stage(classes, "classes")
    chars = classes.agg(F.sum("chars")).first()[0] or 0
    period = period_for(window)
    parts = max(64, chars * len(COVERS[period]) // (5 * period * PARTITION_ENTRIES))

    texts = documents.where(F.length("text") >= 2 * window - 1)
    dealt = texts.select(key, F.col("text").cast("binary")).mapInArrow(_anchors(window, parts), ENTRIES)
    anchors = dealt.groupBy("part").applyInArrow(_settled(parts, shared), HITS)
    anchors = stage(anchors.groupBy("owner").agg(F.collect_list("positions").alias("found")), "anchors")

    # One text for each class that holds a shared anchor.
    wanted = classes.where("rank is not null").join(anchors.select("owner"), "owner", "left_semi").select("owner", "rank")
    wanted = stage(wanted, "wanted")
    few = wanted.count() <= BROADCAST_KEYS
    own = texts.withColumns({"owner": key, "rank": F.col("doc_id").cast("bigint")})
    own = own.join(F.broadcast(wanted) if few else wanted, ["owner", "rank"]).select("owner", "rank", "text")
    own = own.groupBy("owner", "rank").agg(F.first("text").alias("text")).join(anchors, "owner")
    own = own.select("owner", "rank", F.col("text").cast("binary"), "found")
    dealt = own.mapInArrow(_extended(window, parts), ENTRIES)
    hits = dealt.groupBy("part").applyInArrow(_settled(parts, later), HITS)
    hits = hits.groupBy("owner").agg(F.collect_list("positions").alias("found"))

    # Only classes with copies or hits need more than their own text.
    noted = classes.where("copies > 1").select("owner", "rank").join(hits, "owner", "full")
    noted = stage(noted, "noted")
    names = noted.select("owner")
    few = noted.count() <= BROADCAST_KEYS
    names = F.broadcast(names) if few else names
    keyed = documents.withColumn("owner", key)
    plain = keyed.join(names, "owner", "left_anti").select(
        "doc_id", F.col("text").cast("binary"), F.lit(False).alias("copy"), F.lit(None).cast("array<binary>").alias("found")
    )
    other = keyed.join(names, "owner", "left_semi").join(noted, "owner")
    copy = F.coalesce(F.col("doc_id").cast("bigint") > F.col("rank"), F.lit(False))
    other = other.select("doc_id", F.col("text").cast("binary"), copy.alias("copy"), "found")
    kind = documents.schema["doc_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(documents.schema["doc_id"].dataType), pa.int64(), pa.int64(), pa.string()]
    out = pa.schema(list(zip(("doc_id", "n_words", "n_removed", "kept_text"), types, strict=True)))
    schema = f"doc_id {kind}, n_words bigint, n_removed bigint, kept_text string"
    return plain.unionByName(other).mapInArrow(_kept(window, out), schema)
