"""Suffix-array dedup: byte strings that also start in a document with a smaller doc_id.

Documents lie in blocks of ascending doc_id.  Suffixes are compared on their first ``size``
bytes only, so they are first dealt out by what they begin with: the smallest gram hash inside
those bytes, the anchor, is equal for equal strings.  Blocks exchange compressed anchors; only
around anchors that another block has do they send the text, distinct snippets of adjacent
windows.  The owner of an anchor sorts the suffixes of its snippets with the difference-cover
algorithm, compares adjacent prefixes, and answers which windows occur in an earlier block.
Inside a block the same sort settles documents of the block.

Around a line that many documents share every document has a snippet of its own, all with one
anchor.  Anchors whose distinct snippets reach HOT_BYTES are split: blocks exchange compressed
hashes of their windows, and only windows that another block has too are sent, each as a snippet
dealt out by its own hash.

A copy of a whole text needs no sorting: all of it starts in the smallest document too.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strider.llm import text_blocks
from strider.llm.common import HEAVY_SHARE, attach, staged, text_of
from strider.llm.difference_cover import prefix_classes
from strider.llm.exchange import MESSAGE, answered, messages, owner_bounds, shared_flags
from strider.llm.golomb import decode
from strider.llm.rolling import covered, distinct, joined, ranges, sliding_min

#: Bytes of an anchor's gram.
GRAM = 16
#: Bits of an anchor that blocks exchange; a false match only sends a snippet for nothing.
ANCHOR_BITS = 40
BLOCKS_PER_OWNER = 4
#: Bytes of distinct snippets from which on an anchor is split.
HOT_BYTES = 4 << 20
#: Bytes of snippets sorted at a time (one anchor's, if they are more).
SORT_BYTES = 4 << 20
#: Bytes of text hashed at a time.
CHUNK = 1 << 15
ANCHORS = MESSAGE + ", heavy binary"
ANCHOR_ANSWER = "block long, owner int, n long, bitmap binary, hot binary"
SNIPPETS = "block long, owner int, sizes binary, anchors binary, payload binary"
ANSWER = "block long, owner int, n long, bitmap binary"
RESULT = "low long, h1 long, h2 long, n_removed long, n_spans long, kept string"


def earliest(snippets: list[bytes], anchors: np.ndarray, rank: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(smallest rank of any snippet holding the window, first window of each snippet).

    ``snippets`` are distinct; only snippets that share an anchor can share a window, so an
    anchor with one snippet needs no sorting, and anchors are sorted apart from each other.
    """
    length = np.array([len(s) for s in snippets], np.int64)
    windows = length - size + 1
    first = np.cumsum(windows) - windows
    out = np.repeat(rank, windows)
    _, where, count = np.unique(anchors, return_inverse=True, return_counts=True)
    every = np.flatnonzero((count > 1)[where])
    every = every[np.argsort(where[every], kind="stable")]
    ends = np.cumsum(length[every])
    cuts = np.append(np.flatnonzero(np.diff(where[every])) + 1, len(every))
    at = 0
    while at < len(every):
        fits = np.searchsorted(ends, (ends[at - 1] if at else 0) + SORT_BYTES, "right")
        stop = int(cuts[max(np.searchsorted(cuts, fits, "right") - 1, np.searchsorted(cuts, at, "right"))])
        mixed, at = every[at:stop], stop
        data = np.frombuffer(b"".join([snippets[i] for i in mixed]), np.uint8)
        begin = np.cumsum(length[mixed]) - length[mixed]
        places = ranges(first[mixed], windows[mixed])
        group = prefix_classes(data, ranges(begin, windows[mixed]), size)
        low = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, group, out[places])
        out[places] = low[group]
    return out, first


class Block:
    """The texts of a block in order of doc_id: bytes and the anchor of every window."""

    def __init__(self, rows: pd.DataFrame, size: int):
        rows = rows.drop_duplicates(["doc_id", "h1", "h2"]).sort_values(["doc_id", "h1", "h2"])
        self.size, self.h1, self.h2 = size, rows["h1"].to_numpy(), rows["h2"].to_numpy()
        self.doc_id = rows["doc_id"].to_numpy()
        self.rank = np.unique(rows["doc_id"].to_numpy(), return_inverse=True)[1]
        self.texts = [t.encode() for t in rows["text"]]
        length = np.array([len(t) for t in self.texts], np.int64)
        self.starts = np.cumsum(length) - length
        self.data = b"".join(self.texts)
        self._segments(length)
        self.seeds, self.seed_of = np.unique(self.anchor, return_inverse=True)

    def _segments(self, length: np.ndarray) -> None:
        """Runs of windows that follow each other in a text and have one anchor: ``first``
        place, ``count``, ``text`` and ``anchor`` of each."""
        n, size = len(self.data), self.size
        gram = min(GRAM, size)
        if n < size:
            self.first = self.count = self.text = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        least = np.empty(n - size + 1, np.uint64)
        for at in range(0, len(least), CHUNK):   # so much that it stays in the processor's cache
            part = self.data[at:at + CHUNK + size - 1]
            if gram == GRAM:
                words = np.ndarray((len(part) - 7,), "<u8", part, 0, (1,))
                hashes = joined(words[:-8], words[8:])
            else:
                hashes = np.frombuffer(part, np.uint8)[:len(part) - gram + 1].astype(np.uint64)
            least[at:at + CHUNK] = sliding_min(hashes, size - gram + 1)
        texts = np.flatnonzero(length >= size)
        begin, end = self.starts[texts], (self.starts + length)[texts] - size + 1
        edges = distinct(np.concatenate([np.flatnonzero(least[1:] != least[:-1]) + 1, begin, end, [len(least)]]))
        edges = edges[edges <= len(least)]
        first, count = edges[:-1], np.diff(edges)
        own = np.searchsorted(begin, first, side="right") - 1
        inside = (own >= 0) & (first < end[own])
        self.first, self.count, self.text = first[inside], count[inside], texts[own[inside]]
        self.anchor = (least[self.first] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - ANCHOR_BITS)

    def snippets(self, first: np.ndarray, count: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """(snippet number of each run, distinct snippets, anchor of each snippet), snippets in
        order of anchor and bytes."""
        end = first + count + self.size - 1
        data = self.data
        keys = [(a, data[b:e]) for a, b, e in zip(anchor.tolist(), first.tolist(), end.tolist())]
        order = sorted(set(keys))
        number = {k: i for i, k in enumerate(order)}
        return (np.array([number[k] for k in keys], np.int64), [s for _, s in order],
                np.array([a for a, _ in order], np.uint64))

    def heavy(self, light: int) -> tuple[np.ndarray, np.ndarray]:
        """(seeds whose distinct snippets have more than ``light`` bytes, their bytes)."""
        length = self.count + self.size - 1
        chosen = np.flatnonzero((np.bincount(self.seed_of, length, len(self.seeds)) > light)[self.seed_of])
        _, snippets, anchors = self.snippets(self.first[chosen], self.count[chosen], self.anchor[chosen])
        seeds, where = np.unique(anchors, return_inverse=True)
        total = np.bincount(where, [len(s) for s in snippets], len(seeds))
        return np.searchsorted(self.seeds, seeds)[total > light], total[total > light].astype(np.int64)

    def _hot(self, answers: pd.DataFrame) -> np.ndarray:
        """Which seeds are to be split."""
        out, base = np.zeros(len(self.seeds), bool), 0
        for _, n, hot in sorted(zip(answers["owner"], answers["n"], answers["hot"])):
            out[base + np.frombuffer(hot, "<u4").astype(np.int64)] = True
            base += n
        return out

    def hot_windows(self, answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of the windows of anchors that are split."""
        runs = np.flatnonzero(self._hot(answers)[self.seed_of])
        places = ranges(self.first[runs], self.count[runs])
        if self.size >= 8:
            words = np.ndarray((max(0, len(self.data) - 7),), "<u8", self.data, 0, (1,))
            offsets = [*range(0, self.size - 7, 8), self.size - 8]
        else:
            words, offsets = np.frombuffer(self.data, np.uint8).astype(np.uint64), range(self.size)
        hashes = words[places]
        for at in offsets[1:]:
            hashes = joined(hashes, words[places + at])
        return places, (hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - ANCHOR_BITS)

    def live(self, answers: pd.DataFrame, windows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first place, count, anchor) of the runs whose anchor another block has, and of the
        single windows, with their hash as anchor, of split anchors."""
        flags = shared_flags(answers)
        if not len(flags):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        runs = np.flatnonzero((flags & ~self._hot(answers))[self.seed_of])
        places, hashes = self.hot_windows(answers)
        if len(places):
            shared = shared_flags(windows)[np.searchsorted(distinct(hashes), hashes)]
            places, hashes = places[shared], hashes[shared]
        return (np.concatenate([self.first[runs], places]),
                np.concatenate([self.count[runs], np.ones(len(places), np.int64)]),
                np.concatenate([self.anchor[runs], hashes]))

    def local(self) -> np.ndarray:
        """Places of windows that a text of this block with a smaller doc_id has too."""
        base = np.int64(len(self.texts) + 1)
        holders = np.bincount(distinct(self.seed_of * base + self.text) // base, minlength=len(self.seeds))
        chosen = np.flatnonzero((holders > 1)[self.seed_of])
        if not len(chosen):
            return chosen
        number, snippets, anchors = self.snippets(self.first[chosen], self.count[chosen], self.anchor[chosen])
        rank = self.rank[self.text[chosen]]
        low = np.full(len(snippets), np.iinfo(np.int64).max)
        np.minimum.at(low, number, rank)
        least, at = earliest(snippets, anchors, low, self.size)
        count = self.count[chosen]
        again = least[ranges(at[number], count)] < np.repeat(rank, count)
        return ranges(self.first[chosen], count)[again]

    def remote(self, first: np.ndarray, count: np.ndarray, anchor: np.ndarray, answers: pd.DataFrame) -> np.ndarray:
        """Places of windows that an earlier block has, from the answers about the snippets sent."""
        if not len(first):
            return first
        number, snippets, _ = self.snippets(first, count, anchor)
        flags = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for _, n, b in sorted(
            zip(answers["owner"], answers["n"], answers["bitmap"]))]).astype(bool)
        windows = np.array([len(s) for s in snippets], np.int64) - self.size + 1
        at = np.cumsum(windows) - windows
        return ranges(first, count)[flags[ranges(at[number], count)]]


def _send_anchors(size: int, owners: int, light: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows, size)
        seeds, weights = block.heavy(light)
        out, base = [], 0
        for message in messages(int(key[0]), block.seeds, owners, ANCHOR_BITS):
            a, b = np.searchsorted(seeds, [base, base + message[2]])
            out.append((*message, np.stack([seeds[a:b] - base, weights[a:b]]).astype("<u4").tobytes()))
            base += message[2]
        return pd.DataFrame(out, columns=["block", "owner", "n", "k", "payload", "heavy"])
    return run


def _answer_anchors(owners: int, light: int, limit: int):
    """One owner: which anchors another block sent too, and which of those are to be split.

    An anchor's distinct snippets have at most the bytes its blocks named and ``light`` for each
    other block, so none that reaches ``limit`` is missed.
    """
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        base = int(owner_bounds(owners, ANCHOR_BITS)[int(key[0])])
        lists = [decode(n, k, p, base) for n, k, p in zip(rows["n"], rows["k"], rows["payload"])]
        _, where, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        total = count * np.int64(light)
        parts = np.split(where, np.cumsum([len(x) for x in lists])[:-1])
        for part, heavy in zip(parts, rows["heavy"]):
            seeds, weights = np.frombuffer(heavy, "<u4").astype(np.int64).reshape(2, -1)
            total[part[seeds]] += weights - light
        shared = count > 1
        hot = shared & (total >= limit)
        return pd.DataFrame({"block": rows["block"].to_numpy(), "owner": int(key[0]), "n": rows["n"].to_numpy(),
                             "bitmap": [np.packbits(shared[x]).tobytes() for x in parts],
                             "hot": [np.flatnonzero(hot[x]).astype("<u4").tobytes() for x in parts]})
    return run


def _rounds(answers: pd.DataFrame) -> list[pd.DataFrame]:
    """Answers about the anchors, the windows of split anchors, and the snippets."""
    return [answers[answers["round"] == i] for i in range(3)]


def _send_windows(size: int, owners: int):
    def run(key, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and answers["hot"].map(len).any():
            _, hashes = Block(rows, size).hot_windows(answers)
            out = list(messages(int(key[0]), distinct(hashes), owners, ANCHOR_BITS))
        return pd.DataFrame(out, columns=["block", "owner", "n", "k", "payload"])
    return run


def _send_snippets(size: int, owners: int):
    def run(key, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows, size)
        first, second, _ = _rounds(answers)
        _, snippets, anchors = block.snippets(*block.live(first, second))
        owner = (anchors * np.uint64(owners)) >> np.uint64(ANCHOR_BITS)
        out = []
        for o in np.unique(owner).tolist():
            a, b = np.searchsorted(owner, [o, o + 1])
            own = snippets[a:b]
            out.append((int(key[0]), int(o), np.array([len(s) for s in own], "<u4").tobytes(),
                        anchors[a:b].astype("<u4").tobytes(), b"".join(own)))
        return pd.DataFrame(out, columns=["block", "owner", "sizes", "anchors", "payload"])
    return run


def _sort(size: int):
    """One owner: suffixes of all snippets of its anchors."""
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        number: dict[tuple[int, bytes], int] = {}
        lists, low = [], []
        blocks = rows["block"].tolist()
        for block, sizes, anchors, payload in zip(blocks, rows["sizes"], rows["anchors"], rows["payload"]):
            ends = np.cumsum(np.frombuffer(sizes, "<u4").astype(np.int64)).tolist()
            own = []
            for a, b, anchor in zip([0, *ends], ends, np.frombuffer(anchors, "<u4").tolist()):
                i = number.setdefault((anchor, payload[a:b]), len(number))
                if i == len(low):
                    low.append(block)
                elif block < low[i]:
                    low[i] = block
                own.append(i)
            lists.append(np.array(own, np.int64))
        snippets = [s for _, s in number]
        least, first = earliest(snippets, np.array([a for a, _ in number], np.int64), np.array(low, np.int64), size)
        windows = np.array([len(s) for s in snippets], np.int64) - size + 1
        out = []
        for block, own in zip(blocks, lists):
            early = least[ranges(first[own], windows[own])] < block
            out.append((block, int(key[0]), len(early), np.packbits(early).tobytes()))
        return pd.DataFrame(out, columns=["block", "owner", "n", "bitmap"])
    return run


def _remove(size: int):
    def run(key, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows, size)
        first, second, third = _rounds(answers)
        again = distinct(np.concatenate([block.local(), block.remote(*block.live(first, second), third)]))
        gone = covered(len(block.data), again, size)
        data = np.frombuffer(block.data, np.uint8)
        out = []
        for i, text in enumerate(block.texts):
            mask = gone[block.starts[i]:block.starts[i] + len(text)]
            n = int(mask.sum())
            spans = int(np.count_nonzero(np.diff(mask.astype(np.int8), prepend=0) == 1)) if n else 0
            kept = data[block.starts[i]:block.starts[i] + len(text)][~mask].tobytes() if n else text
            out.append((block.doc_id[i], block.h1[i], block.h2[i], n, spans, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(out, columns=["low", "h1", "h2", "n_removed", "n_spans", "kept"])
    return run


def repeated_bytes(docs: DataFrame, size: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removed is every byte covered by a string of ``size`` bytes that also starts in a document
    with a smaller key.  Null text: empty.  A null key is smaller than none and larger than none:
    such rows keep all and take nothing from others.  Rows that repeat a key are not smaller
    than each other.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = text_blocks.prints(docs, key, text, "op10-prints")
    total, volume = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    blocks = text_blocks.block_count(spark, volume)
    owners = max(1, blocks // BLOCKS_PER_OWNER)
    cuts = rows.select(F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)] or [0.5], 10000)).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))
    groups = staged(rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("size")), "op10-groups")
    heavy = groups.where(F.col("size") * HEAVY_SHARE >= F.lit(max(total, 1))).select("h1", "h2", F.col("low").alias("heavy_low"))

    def placed(batches):
        for batch in batches:
            where = np.searchsorted(cuts, batch.column(0).to_numpy(), side="left")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(where, pa.int64())],
                                             names=["doc_id", "h1", "h2", "text", "block"])

    t = text_of(text)
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(t).alias("h1"),
                        F.xxhash64(t, F.lit(1)).alias("h2"), t.alias("text")).where("doc_id is not null")
    texts = texts.join(F.broadcast(heavy), ["h1", "h2"], "left").where("heavy_low is null or heavy_low = doc_id")
    texts = texts.select("doc_id", "h1", "h2", "text").mapInArrow(
        placed, "doc_id long, h1 long, h2 long, text string, block long")
    by_block = text_blocks.stored(texts, blocks, "op10_texts").groupBy("block")

    light = max(2 * size, HOT_BYTES // (2 * blocks))
    sent = by_block.applyInPandas(_send_anchors(size, owners, light), ANCHORS)
    anchors = staged(sent.groupBy("owner").applyInPandas(_answer_anchors(owners, light, HOT_BYTES), ANCHOR_ANSWER)
                     .withColumn("round", F.lit(0)), "op10-anchors")
    answers = anchors
    if not anchors.where(F.length("hot") > 0).isEmpty():
        sent = by_block.cogroup(anchors.groupBy("block")).applyInPandas(_send_windows(size, owners), MESSAGE)
        windows = staged(answered(sent, owners, ANCHOR_BITS), "op10-windows")
        answers = answers.unionByName(windows.withColumn("round", F.lit(1)), allowMissingColumns=True)
    # Sorting takes many times the memory of its snippets: an owner per block.
    sent = by_block.cogroup(answers.groupBy("block")).applyInPandas(_send_snippets(size, blocks), SNIPPETS)
    found = staged(sent.groupBy("owner").applyInPandas(_sort(size), ANSWER), "op10-early")
    answers = answers.unionByName(found.withColumn("round", F.lit(2)), allowMissingColumns=True)
    result = staged(by_block.cogroup(answers.groupBy("block")).applyInPandas(_remove(size), RESULT), "op10-found")
    # Of a text's copies only the smallest document's own answer is used.
    named = groups.join(result, ["h1", "h2", "low"], "left")
    whole = (F.col("doc_id") > F.col("low")) & (F.col("n_bytes") >= size)
    own = F.col("doc_id") == F.col("low")
    none = F.sha2(F.lit(""), 256)
    return attach(rows, named, ["h1", "h2"], "size", total).select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).when(own, F.col("n_removed")).otherwise(0).alias("n_removed"),
        F.when(whole, 1).when(own, F.col("n_spans")).otherwise(0).cast("long").alias("n_spans"),
        F.when(whole, none).when(own, F.col("kept")).otherwise(F.col("sha")).alias("kept_sha256"))
