import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from strider.llm import rolling
from strider.llm import substring_dedup as sub
from strider.llm.queries import QUERIES


def brute(rows, size):
    """[(doc_id, text)] → sorted answers."""
    words = [(i, [w for w in re.split("[\\x20\\x09-\\x0D]+", t or "") if w]) for i, t in rows]
    seen = Counter(tuple(w[s:s + size]) for _, w in words for s in range(len(w) - size + 1))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if seen[tuple(w[s:s + size])] > 1:
                gone[s:s + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def answers(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_windows():
    rng = random.Random(1)
    values = np.array([rng.getrandbits(64) for _ in range(90)], np.uint64)
    for size in (1, 2, 7, 16, 35):
        assert rolling.sliding_min(values, size).tolist() == [min(values[i:i + size].tolist()) for i in range(91 - size)]
        twice = rolling.window_hashes(np.concatenate([values, values]), size)
        assert (twice[:91 - size] == twice[90:]).all() and len(set(twice[:91 - size].tolist())) == 91 - size


@pytest.mark.parametrize("size", [5, 20])
def test_against_brute_force(docs, size):
    rng = random.Random(size)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for d in range(60):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(80))]
        if rng.random() < 0.5:
            a = rng.randrange(40)
            words[5:5] = passage[a:a + rng.randrange(1, 50)]
        rows.append((d, "\n ".join(words)))
    rows += [(100, rows[3][1]), (101, "x " * 50), (102, None), (103, ""), (None, rows[4][1]), (104, "é " * 3 + " ".join(passage))]
    rows += [(3, rows[3][1])]
    assert answers(sub.repeated_words(docs(rows), size)) == brute(rows, size)


def test_very_long_text_and_empty_table(docs):
    rows = [(1, "ab cd " * 30000 + "end"), (2, " ".join(f"u{i}" for i in range(20000)))]
    assert answers(sub.repeated_words(docs(rows))) == brute(rows, 35)
    assert sub.repeated_words(docs([])).count() == 0


def test_registered_query_on_whole_table(spark):
    base = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{base}/documents.parquet").collect()]
    got = answers(QUERIES["op3_substring_dedup"](spark, base))
    assert got == brute(rows, 35) and sum(r[2] for r in got) > 0
