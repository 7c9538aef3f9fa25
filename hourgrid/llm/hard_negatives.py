"""Hard negatives by inner product, read from vector blocks that interval bounds choose.

Vectors are scaled to integers, ordered along a Hilbert curve through their most varied dimensions and cut into blocks, one
Parquet row each, beside the smallest and largest value of every dimension (the zone map). An anchor needs windows of
the score range: its nearest rows of the same label, then the rows of other labels below each of these. Interval
arithmetic on a zone map bounds all scores that a block can hold; a block is read for an anchor only if a window reaches into
these bounds. Windows start narrow because an anchor's own block is searched first: its fifth best score there is a
floor that no better row lies below.

At scale: zone maps and anchors meet in packs (a pack of anchors against some thousand zone maps at a time, boxes first, then
each anchor), never row by row; only chosen (anchor, block) pairs meet vectors. Rows are placed by (curve, vec_id),
so equal vectors, even a third of all rows, spread over many blocks. Each step is written to the shared folder. Nothing
but sums over dimensions reaches the driver. The bounds decide what is read, never what is found; where vectors have no
clusters they exclude little and the work is that of all anchors against all blocks.

Nulls: rows with a null vec_id or label, a null vector, or a null or non-finite component take no part. Shorter vectors count as
if filled with 0; scaled components are cut at 2^20, so a score fits 64 bits. Rows equal in vec_id, label and scaled vector
are one row; other rows of one vec_id are rows of their own. Ties in score go to the smaller vec_id. Anchors
without other rows of their label, and empty tables, give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import stage

LARGEST = 1 << 20
#: The curve runs through so many dimensions, each cut into 2^BITS cells over four deviations to both sides of the mean.
CURVE_DIMS, BITS = 8, 7
#: Rows of a block, anchors of a pack, zone maps of a chunk, and components that any of them holds at most.
BLOCK_ROWS, PACK_ROWS, CHUNK_ROWS, COMPONENTS = 1024, 256, 2048, 1 << 20
LOWEST = np.iinfo(np.int64).min

ROW = "vec_id bigint, label bigint, q array<int>"
BLOCK = "block bigint, n int, ids binary, labels binary, anchors binary, q binary, low binary, high binary, label_low bigint, label_high bigint"
#: An anchor is known by its block and its row there. `tops` and `floors` are its windows.
ANCHOR = "block bigint, row int, vec_id bigint, label bigint, q binary, tops array<bigint>, floors array<bigint>"
PACK = "n int, blocks binary, rows binary, labels binary, q binary, width int, tops binary, floors binary"
FOUND = "anchor_block bigint, anchor_row int, window int, vec_id bigint, score bigint"


def scaled(vectors: DataFrame, id_column: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """(vec_id, label, q) of the rows that take part; a component x becomes floor(256 x)."""

    def unfit(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    def whole(x: Column) -> Column:
        x = x.cast("double") * 256
        return F.floor(F.greatest(F.least(x, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")

    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("x")
    )
    rows = rows.where("vec_id is not null and label is not null and x is not null").where(~F.exists("x", unfit))
    return rows.select("vec_id", "label", F.transform("x", whole).alias("q"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of a batch as a matrix, short ones filled with 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lengths), width), np.int32)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def dimension_sums(rows: DataFrame) -> list:
    """(dimension, rows, sum, sum of squares) of every dimension, summed in the tasks first."""

    def sums(batches):
        n, one, two = 0, np.zeros(0), np.zeros(0)
        for batch in batches:
            lists = batch.column(0)
            if not len(lists):
                continue
            width = max(int(np.diff(lists.offsets.to_numpy()).max()), len(one))
            x = _matrix(lists, width).astype(float)
            n += len(x)
            one = np.pad(one, (0, width - len(one))) + x.sum(0)
            two = np.pad(two, (0, width - len(two))) + (x * x).sum(0)
        if n:
            # Dimension -1 carries the rows, for vectors without any component too.
            yield pa.RecordBatch.from_pydict(
                {"dim": np.arange(-1, len(one)), "one": np.concatenate([[n], one]), "two": np.concatenate([[n], two])}
            )

    parts = rows.select("q").mapInArrow(sums, "dim bigint, one double, two double")
    return parts.groupBy("dim").agg(F.sum("one").alias("one"), F.sum("two").alias("two")).orderBy("dim").collect()


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (rows) with whole coordinates below 2^bits, at most 62 bits in all.

    Coordinates are turned level by level, from the highest bit down: where a coordinate has the bit, the lower bits of the first one
    are flipped, else they are exchanged between the two; the Gray code of the result, read across coordinates, is
    the place.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, lower = 1 << level, (1 << level) - 1
        for d in range(dims):
            has = (x[d] & bit) != 0
            swap = np.where(has, 0, (x[0] ^ x[d]) & lower)
            x[0] ^= np.where(has, lower, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            place = place << 1 | (x[d] >> level & 1)
    return place


def blocks_of(rows: DataFrame, anchor: Column, sums: list) -> DataFrame:
    """Rows on the Hilbert curve, cut into blocks with zone maps."""
    n, width = sums[0].one, len(sums) - 1
    mean = np.array([s.one for s in sums[1:]]) / n
    spread = np.sqrt(np.maximum(np.array([s.two for s in sums[1:]]) / n - mean**2, 0))
    used = np.sort(np.argsort(-spread, kind="stable")[:CURVE_DIMS])
    most = max(1, min(BLOCK_ROWS, COMPONENTS // max(width, 1)))
    kinds = _arrow(BLOCK)

    def placed(batches):
        for batch in batches:
            q = _matrix(batch.column("q"), width)[:, used]
            cell = (q - mean[used]) / np.where(spread[used] > 0, 8 * spread[used], 1) + 0.5
            cell = np.clip(cell * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            place = hilbert_index(cell, BITS) if len(used) else np.zeros(len(q), np.int64)
            yield batch.append_column("place", pa.array(place))

    def cut(batches):
        task, number, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            new = (
                batch.column("vec_id").to_numpy(),
                batch.column("label").to_numpy(),
                batch.column("is_anchor").to_numpy(zero_copy_only=False),
                _matrix(batch.column("q"), width),
            )
            held = tuple(np.concatenate(p) for p in zip(held, new, strict=True)) if held else new
            ids, labels, _, q = held
            again = np.zeros(len(ids), bool)
            again[1:] = (ids[1:] == ids[:-1]) & (labels[1:] == labels[:-1]) & (q[1:] == q[:-1]).all(1)
            held = tuple(p[~again] for p in held)
            # The last rows stay: the next batch may go on with copies of them.
            while len(held[0]) > most:
                yield _batch(kinds, [block(task << 32 | number, *(p[:most] for p in held))])
                held, number = tuple(p[most:] for p in held), number + 1
        if held and len(held[0]):
            yield _batch(kinds, [block(task << 32 | number, *held)])

    def block(number: int, ids, labels, anchors, q) -> tuple:
        by = np.argsort(ids, kind="stable")
        ids, labels, anchors, q = ids[by], labels[by], anchors[by], q[by]
        return (
            number, len(ids), ids.tobytes(), labels.tobytes(), np.flatnonzero(anchors).astype(np.int32).tobytes(),
            q.tobytes(), q.min(0).tobytes(), q.max(0).tobytes(), int(labels.min()), int(labels.max()),
        )

    rows = rows.select("vec_id", "label", F.coalesce(anchor, F.lit(False)).alias("is_anchor"), "q")
    dealt = rows.mapInArrow(placed, "vec_id bigint, label bigint, is_anchor boolean, q array<int>, place bigint")
    dealt = dealt.repartitionByRange("place", "vec_id").sortWithinPartitions("place", "vec_id", "label", "q")
    return dealt.mapInArrow(cut, BLOCK)


def _numbers(value: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(value, kind)


def _rows(value: bytes, n: int, kind=np.int64) -> np.ndarray:
    numbers = _numbers(value, kind)
    return numbers.reshape(n, len(numbers) // max(n, 1))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed, exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    reach = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if reach < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def anchors_of(blocks: DataFrame, wanted: int) -> DataFrame:
    """The anchors, each with a first window: scores of its own label, down to its `wanted`-th best in its own block."""
    kinds = _arrow(ANCHOR)

    def own(batches):
        for batch in batches:
            for b in batch.to_pylist():
                rows = _numbers(b["anchors"], np.int32)
                if not len(rows):
                    continue
                ids, labels = _numbers(b["ids"]), _numbers(b["labels"])
                q = _rows(b["q"], len(ids), np.int32)
                out = []
                for start in range(0, len(rows), PACK_ROWS):
                    some = rows[start : start + PACK_ROWS]
                    for r, scores in zip(some, _products(q[some], q), strict=True):
                        alike = labels == labels[r]
                        alike[r] = False
                        best = np.sort(scores[alike])[::-1][:wanted]
                        floor = int(best[-1]) if len(best) == wanted else LOWEST
                        out.append((b["block"], int(r), int(ids[r]), int(labels[r]), q[r].tobytes(), [], [floor]))
                yield _batch(kinds, out)

    return blocks.select("block", "ids", "labels", "anchors", "q").mapInArrow(own, ANCHOR)


def _packs(anchors: DataFrame) -> DataFrame:
    """Anchors near each other on the curve, packed."""
    kinds = _arrow(PACK)

    def pack(batches):
        held = []
        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= PACK_ROWS:
                yield _batch(kinds, [packed(held[:PACK_ROWS])])
                held = held[PACK_ROWS:]
        if held:
            yield _batch(kinds, [packed(held)])

    def packed(held: list[dict]) -> tuple:
        windows = max(len(a["floors"]) for a in held)
        tops, floors = np.zeros((len(held), windows), np.int64), np.ones((len(held), windows), np.int64)
        for i, a in enumerate(held):
            # Windows that are not there are empty: the floor lies above the top.
            tops[i, : len(a["tops"])], floors[i, : len(a["floors"])] = a["tops"], a["floors"]
        return (
            len(held),
            np.array([a["block"] for a in held], np.int64).tobytes(),
            np.array([a["row"] for a in held], np.int32).tobytes(),
            np.array([a["label"] for a in held], np.int64).tobytes(),
            b"".join(a["q"] for a in held),
            windows,
            tops.tobytes(),
            floors.tobytes(),
        )

    near = anchors.repartitionByRange("block", "row").sortWithinPartitions("block", "row")
    return near.mapInArrow(pack, PACK)


def _zone_chunks(blocks: DataFrame) -> DataFrame:
    """(slot, zone maps of some thousand neighbouring blocks); the vectors of the blocks are not read."""
    chunk = "slot bigint, blocks binary, low binary, high binary, label_low binary, label_high binary"
    kinds = _arrow(chunk)

    def gathered(batches):
        slot, held = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            held += batch.to_pylist()
            size = max(1, min(CHUNK_ROWS, 4 * COMPONENTS // max(len(held[0]["low"]), 1))) if held else 1
            while len(held) > size:
                yield _batch(kinds, [together(slot, held[:size])])
                slot, held = slot + 1, held[size:]
        if held:
            yield _batch(kinds, [together(slot, held)])

    def together(slot: int, held: list[dict]) -> tuple:
        whole = [np.array([z[k] for z in held], np.int64).tobytes() for k in ("block", "label_low", "label_high")]
        return slot, whole[0], b"".join(z["low"] for z in held), b"".join(z["high"] for z in held), whole[1], whole[2]

    zones = blocks.select("block", "low", "high", "label_low", "label_high")
    return zones.repartitionByRange("block").sortWithinPartitions("block").mapInArrow(gathered, chunk)


def chosen(anchors: DataFrame, blocks: DataFrame, same_label: bool) -> DataFrame:
    """(block, pack of the anchors whose windows may reach into it)."""
    chunks = stage(_zone_chunks(blocks), "zones")
    # Every pack meets every chunk of zone maps, a thousandth of the rows, through an equality of slots.
    slots = [r.slot for r in chunks.select("slot").collect()]
    packs = stage(_packs(anchors), "packs").withColumn("slot", F.explode(F.array(*(F.lit(s) for s in slots))))
    met = packs.withColumnRenamed("blocks", "anchor_blocks").withColumnRenamed("labels", "anchor_labels").join(chunks, "slot")
    schema = "block bigint, " + PACK
    kinds = _arrow(schema)

    def choose(batches):
        for batch in batches:
            for m in batch.to_pylist():
                yield from pairs(m)

    def pairs(m: dict) -> Iterator[pa.RecordBatch]:
        n, width = m["n"], m["width"]
        numbers, label_low, label_high = (_numbers(m[k]) for k in ("blocks", "label_low", "label_high"))
        q = _rows(m["q"], n, np.int32).astype(np.int64)
        low, high = (_rows(m[k], len(numbers), np.int32).astype(np.int64) for k in ("low", "high"))
        tops, floors = (_rows(m[k], n) for k in ("tops", "floors"))
        labels = _numbers(m["anchor_labels"])
        # The pack's box against the blocks' boxes first.
        box_low, box_high = q.min(0), q.max(0)
        corners = [a * b for a in (box_low, box_high) for b in (low, high)]
        best = np.maximum.reduce(corners).sum(1)
        some = best >= floors.min()
        if not same_label:
            some &= np.minimum.reduce(corners).sum(1) <= tops.max()
        some = np.flatnonzero(some)
        if not len(some):
            return
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        most = _products(up, high[some]) + _products(down, low[some])
        if same_label:
            reach = (most >= floors) & (labels[:, None] >= label_low[some]) & (labels[:, None] <= label_high[some])
        else:
            least = _products(up, low[some]) + _products(down, high[some])
            reach = np.zeros(most.shape, bool)
            for w in range(width):
                open_ = (tops[:, w] >= floors[:, w])[:, None]
                reach |= open_ & (most >= floors[:, w : w + 1]) & (least <= tops[:, w : w + 1])
            reach &= ~((label_low[some] == label_high[some]) & (labels[:, None] == label_low[some]))
        blocks_, rows_, raw = _numbers(m["anchor_blocks"]), _numbers(m["rows"], np.int32), q.astype(np.int32)
        for j in np.flatnonzero(reach.any(0)):
            a = np.flatnonzero(reach[:, j])
            yield _batch(kinds, [(
                int(numbers[some[j]]), len(a), blocks_[a].tobytes(), rows_[a].tobytes(), labels[a].tobytes(), raw[a].tobytes(),
                width, tops[a].tobytes(), floors[a].tobytes(),
            )])

    return met.mapInArrow(choose, schema)


def searched(pairs: DataFrame, blocks: DataFrame, same_label: bool, wanted: int) -> DataFrame:
    """The `wanted` best rows of each window in each block that was chosen for it."""
    vectors = blocks.select("block", F.col("ids").alias("v_ids"), F.col("labels").alias("v_labels"), F.col("q").alias("v_q"))
    kinds = _arrow(FOUND)

    def search(batches):
        for batch in batches:
            for m in batch.to_pylist():
                found = list(windows(m))
                if found:
                    yield _batch(kinds, found)

    def windows(m: dict) -> Iterator[tuple]:
        n, width = m["n"], m["width"]
        ids, labels = _numbers(m["v_ids"]), _numbers(m["v_labels"])
        scores = _products(_rows(m["q"], n, np.int32), _rows(m["v_q"], len(ids), np.int32))
        tops, floors = (_rows(m[k], n) for k in ("tops", "floors"))
        at, rows, own = _numbers(m["blocks"]), _numbers(m["rows"], np.int32), _numbers(m["labels"])
        for i in range(n):
            fit = labels == own[i] if same_label else labels != own[i]
            if same_label and at[i] == m["block"]:
                fit[rows[i]] = False
            fit &= scores[i] >= floors[i].min()
            places = np.flatnonzero(fit)
            # Rows of a block are ordered by vec_id, so a stable sort settles ties.
            places = places[np.argsort(-scores[i][places], kind="stable")]
            fallen = -scores[i][places]
            for w in range(width):
                start = 0 if same_label else int(np.searchsorted(fallen, -tops[i, w]))
                for p in places[start : start + wanted]:
                    if scores[i][p] < floors[i, w]:
                        break
                    yield int(at[i]), int(rows[i]), w, int(ids[p]), int(scores[i][p])

    return pairs.join(vectors, "block").mapInArrow(search, FOUND)


def best(found: DataFrame, wanted: int) -> DataFrame:
    """`rank` 1 to `wanted` in each window."""
    order = Window.partitionBy("anchor_block", "anchor_row", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def _hundredth(x: Column) -> Column:
    """Whole hundredths, rounded down."""
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))


def mine(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, label, q) rows of `scaled`.

    `anchor` is a condition on these rows. A positive is one of the `positives` best other rows of the anchor's label; its negatives
    are the `negatives` best rows of other labels whose score lies between the two shares of the positive's score.
    """
    sums = dimension_sums(vectors)
    if not sums:
        return vectors.sparkSession.createDataFrame([], RESULT)
    blocks = stage(blocks_of(vectors, anchor, sums), "blocks")
    anchors = stage(anchors_of(blocks, positives), "anchors")
    near = stage(best(searched(chosen(anchors, blocks, True), blocks, True, positives), positives), "positives")

    key = ["anchor_block", "anchor_row"]
    own = F.sort_array(F.collect_list(F.struct((F.col("rank") - 1).alias("window"), "score")))
    ranked = near.groupBy(*key).agg(own.alias("own"))
    score = lambda p: p["score"]
    ranked = ranked.select(
        F.col("anchor_block").alias("block"),
        F.col("anchor_row").alias("row"),
        # Rounded inwards; below 0 the floor lies above the top and the window is empty.
        F.transform("own", lambda p: _hundredth(score(p) * high_percent)).alias("tops"),
        F.transform("own", lambda p: -_hundredth(score(p) * -low_percent)).alias("floors"),
    )
    asked = stage(anchors.drop("tops", "floors").join(ranked, ["block", "row"]).select(*anchors.columns), "windows")
    # The own block first: what it holds raises the floors.
    seen = best(searched(_own_pairs(asked), blocks, False, negatives), negatives).where(F.col("rank") == negatives)
    seen = seen.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("seen"))
    seen = seen.withColumnRenamed("anchor_block", "block").withColumnRenamed("anchor_row", "row")
    raised = asked.join(seen, ["block", "row"], "left").withColumn(
        "floors",
        F.when(F.col("seen").isNull(), F.col("floors")).otherwise(
            F.transform("floors", lambda f, w: F.greatest(f, F.coalesce(F.try_element_at("seen", w), f)))
        ),
    )
    raised = stage(raised.select(*anchors.columns), "floors")
    hard = best(searched(chosen(raised, blocks, False), blocks, False, negatives), negatives)
    hard = hard.select(*key, "window", F.col("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = near.select(
        *key, (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    named = anchors.select(F.col("block").alias("anchor_block"), F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return hard.join(pairs, [*key, "window"]).join(named, key).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _own_pairs(anchors: DataFrame) -> DataFrame:
    """Packs of anchors of one block, for that block."""
    schema = "block bigint, " + PACK
    kinds = _arrow(schema)

    def pack(batches):
        for batch in batches:
            for a in batch.to_pylist():
                width = len(a["floors"])
                yield _batch(kinds, [(
                    a["block"], 1, np.int64(a["block"]).tobytes(), np.int32(a["row"]).tobytes(), np.int64(a["label"]).tobytes(),
                    a["q"], width, np.array(a["tops"], np.int64).tobytes(), np.array(a["floors"], np.int64).tobytes(),
                )])

    return anchors.mapInArrow(pack, schema)
