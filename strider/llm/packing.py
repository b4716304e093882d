"""Packing: first-fit decreasing over a tournament tree of bin capacities, in randomised groups.

Documents are tokenised where they lie.  A document's full windows of ``capacity`` ids are
sequences already; only its remainder is shuffled, to a random group, and packed there.  What
first-fit leaves open is then filled by cutting the pieces of the emptiest bins, and the last
open bin becomes sequences of power-of-two lengths, so nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strider.llm.common import slices, text_of
from strider.llm.tokens import vocabulary

PIECES = "{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tournament:
    """Complete tree over bins; every node holds the largest free capacity below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """Put ``size`` into the leftmost bin with room; its number."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        free[node] -= size
        bin_ = node - self.leaves
        while node > 1:
            node //= 2
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
        return bin_


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers; every size is 1 to ``capacity``."""
    tree = Tournament(max(1, len(sizes)), capacity)
    bins: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.first_fit(sizes[item])
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
    return bins


def levelled(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, from, length): all full but the last, which is cut to powers of two."""
    bins = [[(i, 0, sizes[i]) for i in b] for b in first_fit_decreasing(sizes, capacity)]
    used = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: -used[b])
    front, back = 0, len(order) - 1
    while front < back:
        into, source = order[front], order[back]
        gap = capacity - used[into]
        if gap == 0:
            front += 1
        elif not bins[source]:
            back -= 1
        else:
            item, at, length = bins[source].pop()
            part = min(gap, length)
            bins[into].append((item, at + length - part, part))
            used[into] += part
            used[source] -= part
            if part < length:
                bins[source].append((item, at, length - part))
    out = [bins[b] for b in order if used[b] == capacity]
    for b in order:
        if 0 < used[b] < capacity:
            rest, left = list(bins[b]), used[b]
            while left:
                room = 1 << (left.bit_length() - 1)
                left -= room
                out.append([])
                while room:
                    item, at, length = rest.pop()
                    part = min(room, length)
                    out[-1].append((item, at, part))
                    room -= part
                    if part < length:
                        rest.append((item, at + part, length - part))
    return out


def pack(docs: DataFrame, vocabulary_path: str, capacity: int = 1024, end_id: int = 0, group: int = 4096,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and ``end_id``.  Null text: empty, so the end id alone.  Null and
    repeated keys pass through, each row being a document of its own.  A group has at most
    ``group`` documents; other columns are ignored; an empty table has no pieces.
    """
    rows = docs.select(F.col(key), text_of(text).alias("_text"))
    kind = rows.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocabulary_path)
        width = "<u2" if vocab.size <= 1 << 16 else "<u4"
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                totals, crcs, tails, marks = [], [], [], []
                for x in texts:
                    ids = np.append(vocab.encode(x), np.uint32(end_id)).astype("<u4")
                    full = len(ids) // capacity
                    body = memoryview(ids).cast("B")
                    crc = [zlib.crc32(body[4 * capacity * i:4 * capacity * (i + 1)]) for i in range(full)]
                    totals.append(len(ids))
                    crcs.append(np.array(crc, "<u4").tobytes())
                    tails.append(ids[full * capacity:].astype(width).tobytes())
                    marks.append(zlib.crc32(body))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(totals, pa.int64()),
                     pa.array(crcs, pa.binary()), pa.array(tails, pa.binary()), pa.array(marks, pa.int64())],
                    names=[key, "doc_tokens", "crcs", "tail", "mark"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32
        size = vocabulary(vocabulary_path).size
        width = "<u2" if size <= 1 << 16 else "<u4"
        for found in _groups(batches, group):
            totals = found.column(1).to_pylist()
            where, starts, lengths, crcs, sequences, offsets = [], [], [], [], [], []
            for doc, packed in enumerate(found.column(2)):
                for i, crc in enumerate(np.frombuffer(packed.as_buffer(), "<u4").tolist()):
                    where.append(doc)
                    starts.append(i * capacity)
                    lengths.append(capacity)
                    crcs.append(crc)
                    sequences.append(sequence)
                    offsets.append(0)
                    sequence += 1
            tails = [np.frombuffer(x.as_buffer(), width) for x in found.column(3)]
            items = [d for d, t in enumerate(tails) if len(t)]
            for pieces in levelled([len(tails[d]) for d in items], capacity):
                offset = 0
                for item, at, length in pieces:
                    doc = items[item]
                    where.append(doc)
                    starts.append(totals[doc] - len(tails[doc]) + at)
                    lengths.append(length)
                    crcs.append(zlib.crc32(tails[doc][at:at + length].astype("<u4").tobytes()))
                    sequences.append(sequence)
                    offsets.append(offset)
                    offset += length
                sequence += 1
            take = pa.array(where, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [found.column(0).take(take), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array(crcs, pa.int64()), found.column(1).take(take), pa.array(sequences, pa.int64()),
                 pa.array(offsets, pa.int64())],
                names=[key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    parts = rows.mapInArrow(cut, f"`{key}` {kind}, doc_tokens long, crcs binary, tail binary, mark long")
    draw = F.xxhash64(F.col(key), "mark", "doc_tokens")
    dealt = parts.withColumn("draw", draw).repartition("draw").sortWithinPartitions("draw", key, "mark")
    return dealt.drop("mark", "draw").mapInArrow(fill, PIECES.format(key=f"`{key}`", kind=kind))


def _groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows in the order given, ``most`` at a time."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        at = 0
        while at < len(batch):
            part = batch.slice(at, most - count)
            held.append(part)
            count += len(part)
            at += len(part)
            if count == most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
