"""Substring dedup over words: seeds, then hashes of the windows around them.

Seeds are winnowed anchors: the smallest gram hash of every window of words.  Equal windows
have equal anchors, so documents are joined on anchors alone (a compressed exchange of the
anchors of each block of texts).  No match is extended word by word from its seed.  Instead the
64-bit hashes of all windows around an anchor that another block has are exchanged and compared;
inside a block the hashes of all windows are, without anchors.  Adjacent repeated windows join to
maximal repeats, and their words are removed.

Words themselves are not compared.  Anchors and windows have hashes of independent construction:
no repeat is missed, but two different windows of one 64-bit hash would count as repeated.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strider.llm import text_blocks
from strider.llm.common import attach, staged, text_of
from strider.llm.exchange import MESSAGE, answered, messages, shared_flags
from strider.llm.rolling import covered, distinct, sliding_min, window_hashes

#: Words of an anchor.
GRAM = 16
BLOCKS_PER_OWNER = 4
RESULT = "h1 long, h2 long, n_words long, n_removed long, kept string"
_COLUMNS = ["block", "owner", "n", "k", "payload"]


class Block:
    """The distinct texts of a block: words, anchor and hash of every window."""

    def __init__(self, rows: pd.DataFrame, size: int):
        rows = rows.drop_duplicates(["h1", "h2"]).sort_values(["h1", "h2"])
        self.size, self.h1, self.h2 = size, rows["h1"].to_numpy(), rows["h2"].to_numpy()
        self.words = [t.encode().split() for t in rows["text"]]      # bytes.split: 20, 09-0D
        known: dict[bytes, int] = {}
        digest = xxhash.xxh64_intdigest
        codes = []
        for words in self.words:
            for w in words:
                c = known.get(w)
                if c is None:
                    c = known[w] = digest(w)
                codes.append(c)
        values = np.array(codes, np.uint64)
        counts = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.cumsum(counts) - counts
        self.text = np.repeat(np.arange(len(counts)), counts)
        grams = window_hashes(values, min(GRAM, size))
        anchors = sliding_min(grams, size - min(GRAM, size) + 1)
        hashes = window_hashes(values ^ np.uint64(0x5851F42D4C957F2D), size)
        inside = self.text[:len(hashes)] == self.text[size - 1:] if len(values) >= size else np.zeros(0, bool)
        self.places = np.flatnonzero(inside)         # starts of the windows inside one text
        self.anchors, self.hashes = anchors[self.places], hashes[self.places]
        self.seeds, self.seed_of = np.unique(self.anchors, return_inverse=True)

    def live(self, answers: pd.DataFrame) -> np.ndarray:
        """Windows whose anchor another block has too."""
        flags = shared_flags(answers)
        return flags[self.seed_of] if len(flags) else np.zeros(len(self.places), bool)

    def repeated(self, live: np.ndarray, answers: pd.DataFrame) -> np.ndarray:
        """Windows that start anywhere else: twice in this block, or in another one."""
        _, where, count = np.unique(self.hashes, return_inverse=True, return_counts=True)
        out = (count > 1)[where]
        if live.any():
            _, where = np.unique(self.hashes[live], return_inverse=True)
            out[live] |= shared_flags(answers)[where]
        return out


def _send_seeds(size: int, owners: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(messages(int(key[0]), Block(rows, size).seeds, owners), columns=_COLUMNS)
    return run


def _send_windows(size: int, owners: int):
    def run(key, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows, size)
        return pd.DataFrame(messages(int(key[0]), distinct(block.hashes[block.live(answers)]), owners), columns=_COLUMNS)
    return run


def _remove(size: int):
    def run(key, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows, size)
        first, second = (answers[answers["round"] == i] for i in (1, 2))
        again = block.repeated(block.live(first), second)
        gone = covered(len(block.text), block.places[again], size)
        out = []
        for i, words in enumerate(block.words):
            mask = gone[block.starts[i]:block.starts[i] + len(words)]
            n = int(mask.sum())
            kept = [w for w, g in zip(words, mask.tolist()) if not g] if n else words
            out.append((block.h1[i], block.h2[i], len(words), n, hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(out, columns=["h1", "h2", "n_words", "n_removed", "kept"])
    return run


def repeated_words(docs: DataFrame, size: int = 35, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    A window of ``size`` consecutive words is repeated when its word sequence also starts at
    any other place of any document; every word of a repeated window is removed.  Null text: no
    words.  Rows that repeat a text are documents of their own, so all their windows are
    repeated.  Null keys pass through; other columns are ignored; an empty table gives none.
    """
    spark = docs.sparkSession
    rows = text_blocks.prints(docs, key, text, "op3-prints")
    total, volume = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    blocks = text_blocks.block_count(spark, volume)
    owners = max(1, blocks // BLOCKS_PER_OWNER)
    t = text_of(text)
    texts = docs.select(F.lit(0).cast("long").alias("doc_id"), F.xxhash64(t).alias("h1"),
                        F.xxhash64(t, F.lit(1)).alias("h2"), t.alias("text"))
    store = text_blocks.stored(texts.withColumn("block", F.pmod("h1", F.lit(blocks))), blocks, "op3_texts")
    by_block = store.groupBy("block")
    seeds = staged(answered(by_block.applyInPandas(_send_seeds(size, owners), MESSAGE), owners), "op3-seeds")
    sent = by_block.cogroup(seeds.groupBy("block")).applyInPandas(_send_windows(size, owners), MESSAGE)
    windows = staged(answered(sent, owners), "op3-windows")
    answers = seeds.withColumn("round", F.lit(1)).unionByName(windows.withColumn("round", F.lit(2)))
    found = staged(by_block.cogroup(answers.groupBy("block")).applyInPandas(_remove(size), RESULT), "op3-found")
    sizes = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("size"))
    named = staged(sizes.join(found, ["h1", "h2"]), "op3-named")
    every = (F.col("size") > 1) & (F.col("n_words") >= size)
    return attach(rows.select("doc_id", "h1", "h2"), named, ["h1", "h2"], "size", total).select(
        "doc_id", "n_words", F.when(every, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(every, F.sha2(F.lit(""), 256)).otherwise(F.col("kept")).alias("kept_sha256"))
