"""Benchmark decontamination by q-gram lemma filtering.

An item of m characters that occurs in a document with at most e edits shares at least
m - q + 1 - q*e of its q-grams with the document, and these lie on neighbouring diagonals
(position in the document minus position in the item).  Shared q-grams are counted in
overlapping bands of diagonals; bands that reach the bound are verified by banded alignment.

Texts are lower-cased and runs of white space become one space; characters are the UTF-8 bytes
of that.  Items of fewer than q characters allow no edit: they are found as whole words.  The
benchmark is sent to the tasks in blocks of bounded size, one pass per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strider.llm.common import slices, text_of
from strider.llm.rolling import ranges

Q = 8
EDIT_SHARE = 0.1
#: Bytes of benchmark text that one pass broadcasts.
BLOCK_BYTES = 16 << 20
#: Shared q-grams counted at a time: bounds the memory of texts full of frequent q-grams.
ENTRIES = 1 << 20
_TABLE_BITS = 22
#: Item row of a diagonal that no alignment has reached.
_UNREACHED = -(1 << 40)
#: Eight-byte steps taken on all diagonals at once before the long runs go one by one.
_WORD_STEPS = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: str) -> bytes:
    return " ".join(text.lower().split()).encode()


def _grams(data: bytes) -> np.ndarray:
    """Every q-gram as a number: overlapping 8-byte words of the data."""
    n = len(data) - Q + 1
    return np.ndarray((max(0, n),), "<u8", data, 0, (1,)) if n > 0 else np.zeros(0, "<u8")


def edit_budget(size: int) -> int:
    """Edits allowed for an item: a tenth of its length, while the lemma's bound stays positive."""
    return min(int(size * EDIT_SHARE), (size - Q) // Q)


def _matched(item: bytes, region: bytes, i: int, j: int) -> int:
    """Length of the common run from item[i] and region[j] on, by doubling and halving."""
    start, size = i, 64
    while i + size <= len(item) and item[i:i + size] == region[j:j + size]:
        i, j, size = i + size, j + size, 2 * size
    while size > 1:
        size //= 2
        if i + size <= len(item) and item[i:i + size] == region[j:j + size]:
            i, j = i + size, j + size
    return i - start


def banded_edits(item: bytes, region: bytes, budget: int) -> tuple[int, int] | None:
    """(edits, end) of the best alignment of the item inside the region, None over the budget.

    Semi-global: the region's ends are free.  Only the diagonals an alignment within the budget
    can use are kept, from -budget to the last one that still ends inside the region.  For each,
    the furthest item row reached with e edits is found for e = 0, 1, ... until a diagonal
    reaches the item's end, so the cost follows the edits, not the item's length times the region's.
    """
    size, limit = len(item), len(region)
    diagonal = np.arange(-budget, limit - size + budget + 1)
    # Different ends, neither in any text: no common run passes the end of either side.
    words = np.ndarray((size + 1,), "<u8", item + b"\xfe" * 8, 0, (1,))
    text = np.ndarray((limit + 1,), "<u8", region + b"\xff" * 8, 0, (1,))
    row = np.where((diagonal >= 0) & (diagonal <= limit), 0, _UNREACHED)
    for edits in range(budget + 1):
        if edits:
            padded = np.concatenate([[_UNREACHED], row, [_UNREACHED]])
            row = np.maximum(np.maximum(row, padded[2:]) + 1, padded[:-2])
            row = np.minimum(row, np.minimum(size, limit - diagonal))
        going = np.flatnonzero(row >= 0)
        for _ in range(_WORD_STEPS):
            at = row[going]
            differ = words[at] ^ text[at + diagonal[going]]
            lowest = differ & (~differ + np.uint64(1))
            row[going] = at + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) // 8
            going = going[differ == 0]
            if not len(going):
                break
        for g in going.tolist():
            row[g] += _matched(item, region, int(row[g]), int(row[g] + diagonal[g]))
        done = np.flatnonzero(row == size)
        if len(done):
            return edits, size + int(diagonal[done[0]])
    return None


class Index:
    """Q-grams of a block of items."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.short: dict[bytes, list[int | None]] = {}
        for i, t in items:
            if 0 < len(t) < Q:
                self.short.setdefault(t, []).append(i)
        self.short_words = sorted({t.count(b" ") + 1 for t in self.short})
        self.items = [(i, t) for i, t in items if len(t) >= Q]
        self.budgets = np.array([edit_budget(len(t)) for _, t in self.items], np.int64)
        self.sizes = np.array([len(t) for _, t in self.items], np.int64)
        self.bounds = self.sizes - Q + 1 - Q * self.budgets
        codes = [_grams(t) for _, t in self.items]
        self.codes = np.concatenate(codes) if codes else np.zeros(0, "<u8")
        self.item = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        self.offset = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
        order = np.argsort(self.codes, kind="stable")
        self.item, self.offset = self.item[order], self.offset[order]
        self.codes, self.first = np.unique(self.codes[order], return_index=True)
        self.many = np.diff(np.append(self.first, len(order)))
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[(self.codes * _MIX) >> np.uint64(64 - _TABLE_BITS)] = True

    def regions(self, data: bytes) -> Iterator[tuple[int, int, int]]:
        """(item, first diagonal, last diagonal) of the bands that reach the lemma's bound.

        The text is passed over in steps of at most ENTRIES shared q-grams (one place's, if
        they are more); only bands that later places can still add to are carried on.
        """
        grams = _grams(data)
        if not len(grams) or not len(self.codes):
            return
        places = np.flatnonzero(self.table[(grams * _MIX) >> np.uint64(64 - _TABLE_BITS)])
        rank = np.searchsorted(self.codes, grams[places])
        rank = np.minimum(rank, len(self.codes) - 1)
        known = self.codes[rank] == grams[places]
        places, rank = places[known], rank[known]
        ends = np.cumsum(self.many[rank])
        band = item = seen = np.zeros(0, np.int64)
        at = 0
        while at < len(places):
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + ENTRIES, "right")))
            many = self.many[rank[at:stop]]
            entry = ranges(self.first[rank[at:stop]], many)
            own = self.item[entry]
            # Band b: diagonals [b*width, (b+2)*width).
            high = (np.repeat(places[at:stop], many) - self.offset[entry]) // (self.budgets[own] + 1)
            band, item = np.concatenate([band, high, high - 1]), np.concatenate([item, own, own])
            seen = np.concatenate([seen, np.ones(2 * len(own), np.int64)])
            order = np.lexsort((band, item))
            band, item, seen = band[order], item[order], seen[order]
            starts = np.flatnonzero(np.concatenate([[True], (np.diff(band) != 0) | (np.diff(item) != 0)]))
            band, item, seen = band[starts], item[starts], np.add.reduceat(seen, starts)
            last = (band + 2) * (self.budgets[item] + 1) - 1
            going = last + self.sizes[item] - Q >= places[stop] if stop < len(places) else np.zeros(len(band), bool)
            for s in np.flatnonzero(~going & (seen >= self.bounds[item])):
                yield int(item[s]), int(band[s]) * (int(self.budgets[item[s]]) + 1), int(last[s])
            band, item, seen = band[going], item[going], seen[going]
            at = stop

    def short_ends(self, data: bytes) -> dict[bytes, int]:
        """End of the first place of every item of fewer than Q characters, as whole words."""
        found: dict[bytes, int] = {}
        words = data.split(b" ") if self.short else []
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        starts = [0, *ends[:-1]]
        for many in self.short_words:
            for a, b in zip(starts, ends[many - 1:]):
                if b - a <= Q and data[a:b - 1] in self.short:
                    found.setdefault(data[a:b - 1], b - 1)
        return found

    def hits(self, texts: list[str]) -> Iterator[tuple[int, int | None, int, int, int]]:
        """(document, item_id, edits, end, item length), best place of each item per document."""
        data = [normalised(x) for x in texts]
        starts = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])
        joined = b"\n".join(data)                # a line break is in no item
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for item, first, last in self.regions(joined):
            size, budget = len(self.items[item][1]), int(self.budgets[item])
            doc = int(np.searchsorted(starts, first + size // 2, "right")) - 1
            doc = min(max(doc, 0), len(data) - 1)
            a, b = first - budget - int(starts[doc]), last + size + budget - int(starts[doc])
            found = banded_edits(self.items[item][1], data[doc][max(0, a):max(0, b)], budget)
            if found:
                answer = (found[0], max(0, a) + found[1])
                best[doc, item] = min(best.get((doc, item), answer), answer)
        for (doc, item), (edits, end) in sorted(best.items()):
            yield doc, self.items[item][0], edits, end, len(self.items[item][1])
        for doc, whole in enumerate(data if self.short else []):
            for text, end in self.short_ends(whole).items():
                for item_id in self.short[text]:
                    yield doc, item_id, 0, end, len(text)


_INDEX: dict[int, Index] = {}


def _index(sent) -> Index:
    """The worker's index of a broadcast block; only the last is kept."""
    if sent.value[0] not in _INDEX:
        _INDEX.clear()
        _INDEX[sent.value[0]] = Index(sent.value[1])
    return _INDEX[sent.value[0]]


def _blocks(benchmark: DataFrame):
    """Broadcast blocks of the distinct items, each of about BLOCK_BYTES."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        name = hash((b, tuple(sorted((r.item_id is not None, r.item_id or 0, r.text) for r in own))))
        yield items.sparkSession.sparkContext.broadcast((name, [(r.item_id, normalised(r.text)) for r in own]))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits, end, item_chars): every item found in every document.

    Clean documents have no row.  Null text: empty.  Null doc_ids are reported as null, repeated
    rows row by row; null item_ids likewise.  Items of fewer than Q normalised characters are found
    as whole words; items without any are left out.  Other columns are ignored; with an empty
    table there are no rows.
    """
    kind = "doc_id long, item_id long, edits int, end long, item_chars int"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    out = docs.sparkSession.createDataFrame([], kind)
    for sent in _blocks(benchmark):
        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = _index(sent)
            for batch in batches:
                for at, texts in slices(batch.column(1)):
                    found = list(index.hits(texts))
                    ids = batch.column(0).take(pa.array([at + f[0] for f in found], pa.int64()))
                    columns = [pa.array([f[i] for f in found], t) for i, t in enumerate(
                        (None, pa.int64(), pa.int32(), pa.int64(), pa.int32())) if i]
                    yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "item_id", "edits", "end", "item_chars"])
        out = out.unionByName(rows.mapInArrow(run, kind))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents; all columns, no shuffle."""
    place = docs.columns.index("text")
    for sent in _blocks(benchmark):
        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = _index(sent)
            for batch in batches:
                for at, texts in slices(batch.column(place).fill_null("")):
                    keep = np.ones(len(texts), bool)
                    keep[[f[0] for f in index.hits(texts)]] = False
                    yield batch.slice(at, len(texts)).filter(pa.array(keep))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
