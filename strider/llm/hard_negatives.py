"""Hard negatives by Four-Russians scoring: full exact inner products out of lookup tables.

Every vector is rounded to whole numbers and stored as packed bit planes in two's complement:
one byte holds one bit of eight dimensions.  An anchor gets, for each group of eight
dimensions, the table of all 256 subset sums of its entries there.  A candidate's byte is an
index into that table; the looked-up sums of a plane add up to the plane's product with the
anchor, and the planes are shifted and added to the full score.  No pair is left out and
nothing is estimated.

Anchors are the query set, held against all rows in waves: a wave is at most ``WAVE`` anchors
(their planes are all that is sent to the tasks), and the rows are read once per wave for the
positives and once for the negatives.  The first reading scores rows of the anchor's label
only, the second all others.  Each task keeps the first ``k`` per anchor and positive; a window
over those few rows gives the answer.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strider.llm.common import partitions_for, shared_dir, staged
from strider.llm.vectors import entries, extent, matrix

GROUP = 8
#: Anchors sent to the tasks at once; anchors and rows scored in one step.
WAVE, STEP_ANCHORS, STEP_ROWS = 4096, 128, 2048
#: Rows of a partition of the packed table.
PART_ROWS = 1 << 16
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def planes_for(low: int, high: int) -> int:
    """Bits of two's complement that hold every number from ``low`` to ``high``."""
    return max(int(high).bit_length(), int(-low - 1).bit_length() if low < 0 else 0) + 1


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes: bit j of a byte belongs to dimension 8 * group + j."""
    return np.stack([np.packbits((values >> b & 1).astype(np.uint8), axis=1, bitorder="little")
                     for b in range(planes)], axis=1)


def unpack(packed: np.ndarray) -> np.ndarray:
    """The numbers of ``pack`` again, padded to whole groups."""
    planes = packed.shape[1]
    bits = np.unpackbits(packed, axis=2, bitorder="little").astype(np.int64)
    weights = np.array([1 << b for b in range(planes - 1)] + [-(1 << planes - 1)], np.int64)
    return np.einsum("rpd,p->rd", bits, weights)


def subset_sums(anchors: np.ndarray, dtype) -> np.ndarray:
    """(groups, 256, anchors): the sum of the anchor's entries over every subset of a group."""
    count, width = anchors.shape
    sums = np.zeros((width // GROUP, 1 << GROUP, count), dtype)
    for j in range(GROUP):
        sums[:, 1 << j:2 << j] = sums[:, :1 << j] + anchors[:, j::GROUP].T[:, None, :]
    return sums


def score(packed: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products: lookups per plane, shifted and added from the sign down."""
    rows, planes, groups = packed.shape
    at = packed.astype(np.intp)
    total = np.empty((rows, sums.shape[2]), sums.dtype)
    part = np.empty_like(total)
    for b in range(planes - 1, -1, -1):
        if b == planes - 1:
            total[:] = 0
        else:
            total <<= 1
        add = np.subtract if b == planes - 1 else np.add
        for g in range(groups):
            np.take(sums[g], at[:, b, g], axis=0, out=part, mode="clip")
            add(total, part, out=total)
    return total


class Best:
    """The first ``k`` (score falling, id rising) of every slot, fed in pieces."""

    def __init__(self, slots: int, k: int):
        self.slots, self.k = slots, k
        self.slot, self.score, self.ids = (np.empty(0, np.int64) for _ in range(3))

    def floors(self, least: np.ndarray) -> np.ndarray:
        """Per slot the score from which a newcomer counts: ``least``, or the k-th held if higher."""
        out = least.copy()
        if len(self.slot):
            last = np.flatnonzero(np.bincount(self.slot, minlength=self.slots) >= self.k)
            at = np.searchsorted(self.slot, last, side="right") - 1
            out[last] = np.maximum(out[last], self.score[at])
        return out

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.ids, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        keep = np.arange(len(slot)) - np.searchsorted(slot, slot) < self.k
        self.slot, self.score, self.ids = slot[keep], score[keep], ids[keep]


def kth_floor(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Per column the k-th largest allowed score, so that only few rows are sorted after."""
    low = np.iinfo(np.int64).min
    if len(scores) <= k:
        return np.full(scores.shape[1], low)
    held = np.where(allowed, scores, np.iinfo(scores.dtype).min)
    floor = np.partition(held, len(held) - k, axis=0)[len(held) - k].astype(np.int64)
    return np.where(floor == np.iinfo(scores.dtype).min, low, floor)


def _batches(batches: Iterator[pa.RecordBatch], planes: int, groups: int):
    """(vec_id, label, packed) of at most STEP_ROWS rows each."""
    for batch in batches:
        for at in range(0, batch.num_rows, STEP_ROWS):
            ids, labels, data = batch.slice(at, STEP_ROWS).columns[:3]
            packed = np.frombuffer(b"".join(data.to_pylist()), np.uint8).reshape(-1, planes, groups)
            yield ids.to_numpy(), labels.to_numpy(), packed


def _steps(labels: np.ndarray, by_label: bool) -> list[np.ndarray]:
    """Anchor numbers in steps of at most STEP_ANCHORS, one label each if ``by_label``."""
    if not by_label:
        return [np.arange(at, min(at + STEP_ANCHORS, len(labels))) for at in range(0, len(labels), STEP_ANCHORS)]
    order = np.argsort(labels, kind="stable")
    runs = np.split(order, np.flatnonzero(np.diff(labels[order])) + 1)
    return [run[at:at + STEP_ANCHORS] for run in runs for at in range(0, len(run), STEP_ANCHORS)]


def _positives(ids: np.ndarray, labels: np.ndarray, packed: np.ndarray, k: int, dtype):
    """Per task: the first ``k`` other rows of each anchor's label."""
    planes, groups = packed.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(ids), k)
        steps = [(s, subset_sums(unpack(packed[s]), dtype)) for s in _steps(labels, True)] if len(ids) else []
        least = np.full(len(ids), np.iinfo(np.int64).min)
        for rows, kinds, data in _batches(batches, planes, groups):
            order = np.argsort(kinds, kind="stable")
            names = kinds[order]
            for step, sums in steps:
                own = order[np.searchsorted(names, labels[step[0]], "left"):np.searchsorted(names, labels[step[0]], "right")]
                if not len(own):
                    continue
                found = score(data[own], sums)
                allowed = rows[own][:, None] != ids[step][None, :]
                floor = np.maximum(best.floors(least)[step], kth_floor(found, allowed, k))
                r, a = np.nonzero(allowed & (found >= floor[None, :]))
                best.add(step[a], found[r, a].astype(np.int64), rows[own][r])
        if len(best.slot):
            yield pa.RecordBatch.from_arrays([pa.array(best.slot), pa.array(best.ids), pa.array(best.score)],
                                             names=["slot", "id", "score"])
    return run


def _negatives(ids: np.ndarray, labels: np.ndarray, packed: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, dtype):
    """Per task: of each anchor and positive the first ``k`` rows of other labels from ``low``
    to ``high`` ((anchors, positives) arrays; low > high where there is no such positive)."""
    planes, groups = packed.shape[1:]
    ranks = low.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(low.size, k)
        steps = [(s, subset_sums(unpack(packed[s]), dtype)) for s in _steps(labels, False)]
        for rows, kinds, data in _batches(batches, planes, groups):
            for step, sums in steps:
                found = score(data, sums)
                other = kinds[:, None] != labels[step][None, :]
                floors = best.floors(low.reshape(-1)).reshape(low.shape)[step]
                for i in range(ranks):
                    top = high[step, i]
                    allowed = other & (found <= top[None, :]) & (found >= floors[:, i][None, :])
                    if np.count_nonzero(allowed) > 4 * k * len(step):
                        allowed &= found >= kth_floor(found, allowed, k)[None, :]
                    r, a = np.nonzero(allowed)
                    best.add(step[a] * ranks + i, found[r, a].astype(np.int64), rows[r])
        if len(best.slot):
            yield pa.RecordBatch.from_arrays([pa.array(best.slot), pa.array(best.ids), pa.array(best.score)],
                                             names=["slot", "id", "score"])
    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def packed_rows(rows: DataFrame, key: str, label: str, vector: str, anchor: str, scale: int) -> tuple[DataFrame, int, int, int]:
    """(vec_id, label, packed, anchor) of the rows that take part, one per key, and planes,
    groups and the largest size a score can have."""
    count, width, low, high = extent(rows.where(F.col(key).isNotNull() & F.col(label).isNotNull()), vector, scale)
    planes, groups = planes_for(low, high), -(-width // GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, flat, ok = entries(batch.column(2), scale)
            if not ok.any():
                continue
            data = pack(matrix(sizes[ok], flat, width), planes).reshape(int(ok.sum()), -1)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep),
                 pa.array([x.tobytes() for x in data], pa.binary()), batch.column(3).filter(keep)],
                names=["vec_id", "label", "packed", "anchor"])

    spark = rows.sparkSession
    table = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"),
        F.coalesce(F.col(anchor), F.lit(False)).alias("anchor"))
    one = (table.mapInArrow(run, "vec_id long, label long, packed binary, anchor boolean")
           .repartition(partitions_for(spark, count, PART_ROWS), "vec_id")
           .groupBy("vec_id").agg(F.min(F.struct("label", "packed", "anchor")).alias("row"))
           .select("vec_id", "row.label", "row.packed", "row.anchor"))
    return staged(one, "op12-rows"), planes, groups, width * max(-low, high) ** 2


def mine(rows: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
         key: str = "vec_id", label: str = "label", vector: str = "embedding", anchor: str = "anchor",
         wave: int = WAVE) -> DataFrame:
    """Hard negatives of the rows whose boolean column ``anchor`` is true.

    Entries become floor(scale * entry); a score is the whole-number inner product; higher
    scores come first, ties by the smaller key.  Of an anchor's first ``positives`` other rows of
    its label each gets the first ``negatives`` rows of other labels with
    low * positive <= 100 * negative <= high * positive.  One row per anchor, positive and rank.

    Null key or label, a null vector or one with a null, NaN or infinite entry: takes no part.
    A null ``anchor``: no anchor.  Rows that repeat a key: the one with the smallest label, then
    vector, stands for all.  A shorter vector counts as ending in zeros.  Other columns are
    ignored; an empty table, or one without anchors, gives an empty result.  Entries so large
    that a score might not fit a long: an error.
    """
    spark = rows.sparkSession
    table, planes, groups, largest = packed_rows(rows, key, label, vector, anchor, scale)
    if largest >= 2 ** 62 // max(low, high, 100):
        raise ValueError("inner products of these vectors do not fit a long")
    dtype = np.int32 if largest < 2 ** 30 else np.int64
    anchors = table.where("anchor")
    waves = -(-anchors.count() // wave) if groups else 0
    out = f"{shared_dir(spark)}/op12-found-{uuid.uuid4().hex}"
    done = 0
    for w in range(waves):
        members = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == w).select("vec_id", "label", "packed").collect()
        for at in range(0, len(members), wave):
            _wave(table, members[at:at + wave], planes, groups, dtype, positives, negatives, low, high).write.parquet(
                f"{out}/part={done}")
            done += 1
    if not done:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(f"{out}/part=*")


def _wave(table: DataFrame, members: list, planes: int, groups: int, dtype, positives: int, negatives: int,
          low: int, high: int) -> DataFrame:
    """The answer for the anchors ``members`` (bounded by the wave)."""
    spark = table.sparkSession
    ids = np.array([m.vec_id for m in members], np.int64)
    labels = np.array([m.label for m in members], np.int64)
    packed = np.frombuffer(b"".join(bytes(m.packed) for m in members), np.uint8).reshape(-1, planes, groups)
    rows = table.select("vec_id", "label", "packed")
    kind = "slot long, id long, score long"
    firsts = _first(rows.mapInArrow(_positives(ids, labels, packed, positives, dtype), kind), positives).collect()
    least, most = np.ones((len(ids), positives), np.int64), np.zeros((len(ids), positives), np.int64)
    names = []
    for r in firsts:
        least[r.slot, r.rank - 1], most[r.slot, r.rank - 1] = -(-low * r.score // 100), high * r.score // 100
        names.append((r.slot * positives + r.rank - 1, int(ids[r.slot]), r.id, r.score))
    found = _first(rows.mapInArrow(_negatives(ids, labels, packed, least, most, negatives, dtype), kind), negatives)
    slots = spark.createDataFrame(names, "slot long, anchor_id long, positive_id long, positive_score long")
    return found.join(F.broadcast(slots), "slot").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
