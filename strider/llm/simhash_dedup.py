"""SimHash near-dedup with covering locality-sensitive hashing.

For radius r the 2**(r+1) - 1 bit masks are built from a code: bit i gets a vector over
{0,1}**(r+1), and mask v keeps the bits whose vector has odd product with v.  However r bits
differ, some v is orthogonal to all their vectors: the pair is equal under that mask and meets
in that table.  No pair within the radius is missed.

A bucket is searched in memory while it holds at most ``bucket_limit`` fingerprints.  A larger
one is split by the same construction over the bits its mask left free, as often as needed;
distinct fingerprints that agree on all but f bits number at most 2**f, so this ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strider.llm.common import attach, slices, staged, text_of
from strider.llm.components import components

BITS = 64
SEED = 42
#: Distinct fingerprints of a bucket compared in one task.
BUCKET_LIMIT = 8192
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles of a text."""
    words = text.encode().translate(_LOWER).split()   # bytes.split: space and 09-0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    first = [0, *ends[:-1].tolist()]
    size = min(shingle, len(words))
    last = (ends[size - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first, last)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def masks(radius: int, free: int) -> list[int]:
    """Covering masks over the bits set in ``free``.

    The unit vectors come first, so with more than ``radius`` bits no mask is empty.
    """
    places = [i for i in range(BITS) if free >> i & 1]
    units = [1 << i for i in range(radius + 1)]
    codes = units + [c for c in range(1, 1 << (radius + 1)) if c not in units]
    return [sum(1 << place for rank, place in enumerate(places) if (codes[rank % len(codes)] & v).bit_count() % 2)
            for v in range(1, 1 << (radius + 1))]


def local_links(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(member, smallest member) for the linked groups among distinct sorted fingerprints."""
    left, out = prints, []
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            near = np.bitwise_count(left ^ front.pop()) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                out += [(int(x), int(root)) for x in found]
                front += list(found)
    return out


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _spread(radius: int):
    """Rows of every table: (bucket, free, fp) → (bucket of the table, bits still free, fp)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, free, fp = (c.to_numpy().view(np.uint64) for c in batch.columns)
            for kind in np.unique(free):
                own = free == kind
                for v, mask in enumerate(masks(radius, int(kind))):
                    key = (fp[own] & np.uint64(mask)) ^ (bucket[own] * np.uint64(0x9E3779B97F4A7C15))
                    key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(v + 1)
                    rest = np.full(len(key), int(kind) & ~mask, np.uint64)
                    yield pa.RecordBatch.from_arrays([_signed(key), _signed(rest), _signed(fp[own])],
                                                     names=["bucket", "free", "fp"])
    return run


def _search(radius: int, limit: int):
    """Links of every bucket; rows of buckets over the limit come back as they are.

    Fingerprints that agree on all but ``radius`` bits are 2**radius at most: never split.
    """
    limit = max(limit, 1 << radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        at = None
        over = False

        def emit(rows: list[tuple], kind: str) -> pa.RecordBatch:
            a, b, c = (zip(*rows)) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array([kind] * len(rows), pa.string()), _signed(a), _signed(b), _signed(c)],
                                              names=["kind", "bucket", "free", "fp"])

        def close() -> Iterator[pa.RecordBatch]:
            if held and not over:
                found = local_links(np.unique(np.concatenate(held)), radius)
                if found:
                    yield emit([(root, 0, x) for x, root in found], "link")

        for batch in batches:
            bucket, free, fp = (c.to_numpy().view(np.uint64) for c in batch.columns)
            if not len(bucket):
                continue
            cuts = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(free) != 0)) + 1
            starts = np.concatenate([[0], cuts])
            ends = np.concatenate([cuts, [len(bucket)]])
            first_open = at == (bucket[0], free[0])
            busy = np.flatnonzero((ends - starts > 1) | (np.arange(len(ends)) == len(ends) - 1)
                                  | ((np.arange(len(ends)) == 0) & first_open))
            links: list[tuple] = []
            for i in busy.tolist():
                s, e = int(starts[i]), int(ends[i])
                name = (bucket[s], free[s])
                if name != at:
                    yield from close()
                    held, at, over = [], name, False
                held.append(fp[s:e])
                if over or sum(map(len, held)) > limit:
                    for part in held:
                        yield emit([(name[0], name[1], x) for x in part], "split")
                    held, over = [], True
                elif i < len(ends) - 1:
                    found = local_links(np.unique(np.concatenate(held)), radius)
                    links += [(root, 0, x) for x, root in found]
                    held, at = [], None
            if links:
                yield emit(links, "link")
        yield from close()
    return run


def links(prints: DataFrame, radius: int, limit: int = BUCKET_LIMIT) -> DataFrame:
    """(a, b) links that connect the distinct fingerprints ``fp`` as all pairs within the
    radius do: of each bucket every member is linked to the smallest one it can reach there."""
    rows = prints.select(F.lit(0).cast("long").alias("bucket"), F.lit(-1).cast("long").alias("free"), "fp")
    found = None
    while True:
        tables = rows.mapInArrow(_spread(radius), "bucket long, free long, fp long")
        dealt = tables.repartition("bucket", "free").sortWithinPartitions("bucket", "free", "fp")
        out = staged(dealt.mapInArrow(_search(radius, limit), "kind string, bucket long, free long, fp long"), "op9-found")
        new = out.where("kind = 'link'").select(F.col("fp").alias("a"), F.col("bucket").alias("b"))
        found = new if found is None else found.unionByName(new)
        rows = out.where("kind = 'split'").drop("kind")
        if rows.isEmpty():
            return found.distinct()


def _prints(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows`` (one column and the text) with the text's fingerprint ``fp`` in place of the text."""
    name, kind = rows.columns[0], rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), _signed([fingerprint(x, shingle) for x in texts])],
                    names=[name, "fp"])
    return rows.mapInArrow(run, f"{name} {kind}, fp long")


def _grouped(docs: DataFrame, shingle: int, radius: int, bucket_limit: int, key: str, text: str):
    """Staged rows (doc_id, fp), staged fingerprints (fp, size, root, component_id) and the number
    of rows; component_id is null where no row of the component has a key."""
    rows = staged(_prints(docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text")), shingle), "op9-prints")
    total = rows.count()
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("size")), "op9-distinct")
    roots = components(links(prints, radius, bucket_limit)).withColumnRenamed("node", "fp")
    linked = staged(prints.join(roots, "fp"), "op9-linked")
    groups = linked.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("prints"))
    members = attach(linked.select("fp", "root"), groups, ["root"], "prints", total)
    named = staged(prints.join(members.select("fp", "root", "component_id"), "fp", "left")
                   .select("fp", "size", F.coalesce("root", "fp").alias("root"),
                           F.coalesce("component_id", "low").alias("component_id")), "op9-named")
    return rows, named, total


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, bucket_limit: int = BUCKET_LIMIT,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex), component_id (smallest key of
    the component).

    Null text: empty.  A text without words has fingerprint zero and is linked like any other.
    Null keys are never the smallest unless a component has no other.  Rows that repeat a key
    each get their row.  Other columns are ignored; an empty table gives an empty result.
    """
    return _answer(*_grouped(docs, shingle, radius, bucket_limit, key, text))


def _answer(rows: DataFrame, named: DataFrame, total: int) -> DataFrame:
    return attach(rows, named.drop("root"), ["fp"], "size", total).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id.

    Of rows that repeat that doc_id and the text one stays.  Rows without doc_id go where the
    component has a row with one; where none has, one row with the smallest text stays.
    """
    prints, named, total = _grouped(docs, shingle, radius, BUCKET_LIMIT, "doc_id", "text")
    stay = _answer(prints, named, total).groupBy("doc_id").agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count(F.lit(1)).alias("n"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), text_of().alias("whole"))
    joined = rows.join(stay.where("stays"), F.col("id") == F.col("doc_id"))
    again = joined.where("n > 1").dropDuplicates(["id", "whole"])
    nameless = rows.where("id is null")
    texts = nameless.select("whole").distinct()
    chosen = (_prints(texts.select("whole", F.col("whole").alias("text")), shingle)
              .join(named.where("component_id is null").select("fp", "root"), "fp")
              .groupBy("root").agg(F.min("whole").alias("whole")).select("whole"))
    return (joined.where("n = 1").select("row.*").unionByName(again.select("row.*"))
            .unionByName(nameless.join(chosen, "whole").dropDuplicates(["whole"]).select("row.*")))
