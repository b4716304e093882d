"""Document fingerprints: the k smallest shingle hashes of a text (bottom-k sketch).

A shingle is five consecutive words, A-Z lower-cased; the first four words have shingles of
their own that start before the text, so a text of one word has one.  A sketch of fewer than
k hashes is the whole set, and all that is estimated from it is exact.  The k smallest of two
sketches put together are the sketch of both texts together: sketches merge over parts,
documents, sources and days, in any order.

``succession`` hands every document the one after it.  Rows are dealt to contiguous ranges of
the order, cut at borders of equal bytes, so neighbours meet in one task; the first row of a
range also goes to the range before it.  A task reads its rows one after another and holds two.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from strider.llm.common import partitions_for, staged, text_of

SHINGLE, SIZE, SEED = 5, 128, 42
#: Words hashed at once: a very long text is sketched in parts.
PART_WORDS = 1 << 17
#: Bytes of text a range of ``succession`` holds; borders sent to the tasks at most.
RANGE_BYTES, MAX_RANGES = 32 << 20, 1 << 16
#: Rows of an output batch.
OUT_ROWS = 256
SPACE = 2.0 ** 64
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """One hash per word: of the ``shingle`` words that end there (zeros before the first)."""
    if shingle > len(_ODD):
        raise ValueError(f"a shingle has at most {len(_ODD)} words")
    total = np.zeros(len(words), np.uint64)
    for back in range(min(shingle, len(words))):
        total[back:] += words[:len(words) - back] * _ODD[back]
    return _mixed(total)


def smallest(hashes: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` smallest distinct hashes, sorted."""
    hashes = np.unique(hashes) if len(hashes) <= 4 * size else _smallest_of_many(hashes, size)
    return hashes[:size]


def _smallest_of_many(hashes: np.ndarray, size: int) -> np.ndarray:
    """As ``np.unique``, but looks at more than the first 4 * size hashes only if copies crowd them."""
    take = 4 * size
    while take < len(hashes):
        found = np.unique(np.partition(hashes, take - 1)[:take])
        if len(found) >= size:
            return found
        take *= 4
    return np.unique(hashes)


def sketch(text: str | None, size: int = SIZE, shingle: int = SHINGLE) -> np.ndarray:
    """Sketch of a text; of one without words: empty."""
    words = (text or "").encode().translate(_LOWER).split()   # bytes.split: space and 09-0D
    found = np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(words), PART_WORDS):
        start = max(0, at - shingle + 1)
        part = words[start:at + PART_WORDS]
        codes = np.fromiter((digest(w, SEED) for w in part), np.uint64, len(part))
        found = smallest(np.concatenate([found, shingle_hashes(codes, shingle)[at - start:]]), size)
    return found


def encode(hashes: np.ndarray) -> str:
    """The sketch as text (base64 of little-endian numbers)."""
    return base64.b64encode(hashes.astype("<u8").tobytes()).decode()


def decode(text: str | None) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text or ""), "<u8")


def merge(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The sketch of both sets together."""
    return smallest(np.concatenate([a, b]), size)


def distinct_count(hashes: np.ndarray, size: int = SIZE) -> float:
    """Distinct shingles: exact below ``size``, else (size - 1) / share of the space below the last."""
    return float(len(hashes)) if len(hashes) < size else (size - 1) * SPACE / (float(hashes[size - 1]) + 1)


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Shared part of all shingles, 0 to 1.  Two empty sketches are equal (1)."""
    union = merge(a, b, size)
    if not len(union):
        return 1.0
    return len(np.intersect1d(np.intersect1d(a, b, True), union, True)) / len(union)


def containment(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Part of a's shingles that b has, 0 to 1.  An empty a is contained in everything."""
    own = distinct_count(a, size)
    if not own:
        return 1.0
    return min(1.0, resemblance(a, b, size) * distinct_count(merge(a, b, size), size) / own)


def fingerprints(docs: DataFrame, size: int = SIZE, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text",
                 by: list[str] | None = None) -> DataFrame:
    """key, the columns ``by``, fingerprint, n_shingles (double: distinct shingles) per row.

    Null text counts as empty: an empty fingerprint, 0 shingles.  Null and repeated keys keep
    their rows.  Other columns are ignored; an empty table gives an empty result.
    """
    by = by or []
    rows = docs.select(key, *by, text_of(text).alias("_text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(x.as_py(), size, shingle) for x in batch.column(len(by) + 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([encode(x) for x in found], pa.string()),
                 pa.array([distinct_count(x, size) for x in found], pa.float64())],
                names=[*batch.schema.names[:-1], "fingerprint", "n_shingles"])
    return rows.mapInArrow(run, f"{kinds}fingerprint string, n_shingles double")


def merged(prints: DataFrame, by: list[str], size: int = SIZE, fingerprint: str = "fingerprint") -> DataFrame:
    """``by``, fingerprint, n_shingles: one sketch per group, equal to that of all its texts.

    Hashes are made distinct, each task keeps the ``size`` smallest of every group (Spark limits
    the window before its shuffle), and those few are ranked per group.  A null fingerprint adds nothing; a group
    without hashes has an empty one.  Null group values form groups.  ``size`` must not exceed
    the size the parts were made with.
    """
    rows = prints.select(*by, F.col(fingerprint).alias("_print"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [decode(x.as_py())[:size] for x in batch.column(len(by))]
            many = np.repeat(np.arange(len(found)), [len(x) for x in found])
            flat = np.concatenate([*found, np.empty(0, np.uint64)]).astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array(many)) for c in batch.columns[:-1]], pa.array((flat ^ np.uint64(1 << 63)).view(np.int64))],
                names=[*batch.schema.names[:-1], "hash"])

    # The sign bit is turned so that signed order is the order of the hashes.
    hashes = rows.mapInArrow(unpack, f"{kinds}hash long")
    window = Window.partitionBy(*by).orderBy("hash")
    few = (hashes.distinct().withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= size)
           .groupBy(*by).agg(F.sort_array(F.collect_list("hash")).alias("_hashes")))
    back = few
    if by:
        same = [F.col(f"g.{c}").eqNullSafe(F.col(f"f.{c}")) for c in by]
        back = rows.select(*by).distinct().alias("g").join(few.alias("f"), same, "left").select(
            *[F.col(f"g.{c}").alias(c) for c in by], "_hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(x.as_py() or [], np.int64).view(np.uint64) ^ np.uint64(1 << 63) for x in batch.column(len(by))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([encode(x) for x in found], pa.string()),
                 pa.array([distinct_count(x, size) for x in found], pa.float64())],
                names=[*batch.schema.names[:-1], "fingerprint", "n_shingles"])
    return back.mapInArrow(run, f"{kinds}fingerprint string, n_shingles double")


def compare(pairs: DataFrame, left: str, right: str, size: int = SIZE) -> DataFrame:
    """``pairs`` with resemblance, containment (of left in right) and n_union of two fingerprint
    columns.  A null fingerprint counts as empty."""
    schema = StructType([*pairs.schema.fields, *[StructField(n, DoubleType()) for n in ("resemblance", "containment", "n_union")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([decode(x.as_py()) for x in batch.column(batch.schema.get_field_index(c))] for c in (left, right))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array([f(x, y, size) for x, y in zip(a, b)], pa.float64()) for f in (
                    resemblance, containment, lambda x, y, s: distinct_count(merge(x, y, s), s))]],
                names=[*batch.schema.names, "resemblance", "containment", "n_union"])
    return pairs.mapInArrow(run, schema)


def _borders(keys: DataFrame, ranges: int) -> list[tuple[int, int, int]]:
    """First (null last, -id, tie) of every range but the first, cut at equal bytes.

    ``keys``: doc_id, tie, size.  Sorted ranges of keys are summed, then cut again inside.
    """
    total = int(keys.agg(F.sum("size")).first()[0] or 0)
    order = [F.desc_nulls_last("doc_id"), F.asc("tie")]
    parts = partitions_for(keys.sparkSession, total, 1 << 30)
    dealt = staged(keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "op11-order")
    sums = {r["part"]: int(r["bytes"]) for r in dealt.groupBy("part").agg(F.sum("size").alias("bytes")).collect()}
    spark, before, rows = keys.sparkSession, 0, []
    for part in sorted(sums):
        rows.append((part, before))
        before += sums[part]
    starts = F.broadcast(spark.createDataFrame(rows, "part int, before long"))
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.join(starts, "part").select("doc_id", "tie", F.floor(
        (F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))) * F.lit(float(ranges)) / F.lit(float(max(total, 1)))).alias("range"))
    named = F.struct(F.col("doc_id").isNull().cast("int").alias("none"), (-F.coalesce("doc_id", F.lit(0))).alias("back"), F.col("tie"))
    firsts = placed.groupBy("range").agg(F.min(named).alias("first")).where("range > 0").select("first.*").collect()
    return sorted({(r.none, r.back, r.tie) for r in firsts})


def succession(docs: DataFrame, row: Callable[[int | None, str, str], tuple], kind: str, key: str = "doc_id",
               text: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``row(key, text, text of the next document)`` for every row, typed as ``kind`` (the key first).

    Order: falling key, rows without key last, ties by the hash of the text, then the text; after
    the last comes the first.  Every row counts, repeated ones too (identical ones stand
    together).  A single row follows itself; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    keys = staged(source.select("doc_id", "tie", (F.octet_length("text") + 64).alias("size")), "op11-keys")
    total = int(keys.agg(F.sum("size")).first()[0] or 0)
    if not total:
        return spark.createDataFrame([], kind)
    borders = _borders(keys, min(partitions_for(spark, total, range_bytes), MAX_RANGES))
    first = keys.orderBy(F.desc_nulls_last("doc_id"), "tie").select("doc_id", "tie").first()
    start = (int(first.doc_id is None), -(first.doc_id or 0), first.tie)
    ranges = len(borders) + 1
    names = {b: i + 1 for i, b in enumerate(borders)}
    cuts = np.array(borders, np.int64).reshape(-1, 3)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(range, tail, row): rows at a border, and the very first, also as tail of the range before."""
        table = [tuple(x) for x in cuts.tolist()]
        for batch in batches:
            ids, ties = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            places = [(int(i is None), -(i or 0), t) for i, t in zip(ids, ties)]
            at, where, tail = list(range(len(ids))), [bisect_right(table, p) for p in places], [False] * len(ids)
            for n, p in enumerate(places):
                if p in names:
                    at.append(n), where.append(names[p] - 1), tail.append(True)
                if p == start:
                    at.append(n), where.append(ranges - 1), tail.append(True)
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), pa.array(tail, pa.bool_()),
                                              *[c.take(pa.array(at, pa.int64())) for c in batch.columns]],
                                             names=["range", "tail", "doc_id", "text", "tie"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ready = None, []
        for batch in batches:
            for where, tail, doc, words in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None and not held[1] and held[0] == where:
                    ready.append(row(held[2], held[3], words))
                held = (where, tail, doc, words)
                if len(ready) >= OUT_ROWS:
                    yield _batch(ready, schema)
                    ready = []
        if ready:
            yield _batch(ready, schema)

    schema = to_arrow_schema(StructType.fromDDL(kind))
    dealt = (source.mapInArrow(deal, "range int, tail boolean, doc_id long, text string, tie long")
             .repartitionById(ranges, "range")
             .sortWithinPartitions("range", "tail", F.desc_nulls_last("doc_id"), "tie", "text"))
    return dealt.select("range", "tail", "doc_id", "text").mapInArrow(walk, kind)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edited_likeness(docs: DataFrame, size: int = SIZE, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they are.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (of
    the next document in falling key order), n_shingles, kept_share (containment of the text's
    shingles in the edited text's).  Null text: empty.  Order, ties, repeated rows, null keys, a
    single row and the empty table: as ``succession`` says.  Other columns are ignored.
    """
    last: dict[str, np.ndarray] = {}

    def known(words: str) -> np.ndarray:
        """The next document's sketch is used again as the text's own."""
        if words not in last:
            last.clear()
            last[words] = sketch(words, size, shingle)
        return last[words]

    def row(doc: int | None, words: str, following: str) -> tuple:
        own = known(words)
        other = known(following)
        changed = edited(words, following)
        new = sketch(changed, size, shingle)
        return (doc, len(words), hashlib.sha256(changed.encode()).hexdigest(), encode(own), encode(new),
                resemblance(own, new, size), resemblance(own, other, size), distinct_count(own, size),
                containment(own, new, size))

    return succession(docs, row, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                      "edited_fingerprint string, near_edited double, near_next double, n_shingles double, "
                      "kept_share double", key, text)
