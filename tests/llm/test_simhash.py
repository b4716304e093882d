import random
import re

import numpy as np
import pytest
import xxhash

from strider.llm import simhash_dedup as sd
from strider.llm.queries import QUERIES


def brute_fingerprint(text, size=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\\x20\\x09-\\x0D]+", words) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    """prints: {doc_id: fp} → {doc_id: smallest doc_id reachable}."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    left, out = set(range(len(ids))), {}
    for i in range(len(ids)):
        if i not in left:
            continue
        left.discard(i)
        front = [i]
        while front:
            at = front.pop()
            out[ids[at]] = ids[i]
            near = np.flatnonzero(np.bitwise_count(values ^ values[at]) <= radius)
            new = [j for j in near.tolist() if j in left]
            left.difference_update(new)
            front += new
    return out


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(5)
    for free in (2 ** 64 - 1, 0xFFFF0000FFFF, 0xFF):
        bits = [i for i in range(64) if free >> i & 1]
        made = sd.masks(4, free)
        for _ in range(3000):
            differ = sum(1 << b for b in rng.sample(bits, rng.randint(0, 4)))
            assert any(not differ & m for m in made)


@pytest.mark.parametrize("limit", [1000, 3])
def test_links_equal_all_pairs(spark, limit):
    rng = random.Random(limit)
    values = {0}
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(25):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
            values.add(base)
    values = sorted(values)
    table = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    roots = {r.node: r.root for r in sd.components(sd.links(table, 4, limit)).collect()}
    want = brute_components(dict(enumerate(values)))
    got = {}
    for i, v in enumerate(values):
        signed = int(np.uint64(v).view(np.int64))
        got.setdefault(roots.get(signed, signed), []).append(i)
    assert sorted(map(sorted, got.values())) == sorted(
        sorted(i for i in want if want[i] == r) for r in set(want.values()))


def test_odd_rows(docs):
    rows = [(1, "Alpha beta gamma delta"), (2, "alpha  BETA\ngamma delta"), (3, None), (4, ""), (5, " \t"),
            (2, "alpha beta gamma delta"), (None, "alpha beta gamma delta"), (7, "one two"), (8, "word " * 40000)]
    got = sd.near_duplicates(docs(rows)).collect()
    assert len(got) == len(rows)
    want = {i: brute_fingerprint(t) for i, t in rows if i is not None}
    for r in got:
        if r.doc_id is not None:
            assert int(r.fingerprint, 16) == want[r.doc_id]
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, None: 1, 3: 3, 4: 3, 5: 3, 7: 7, 8: 8}
    assert sd.near_duplicates(docs([])).count() == 0
    assert sd.deduplicate(docs([(1, "a b"), (1, "a b"), (2, "a b")])).count() == 1
    assert sorted(r.doc_id for r in sd.deduplicate(docs(rows)).collect()) == [1, 3, 7, 8]


def test_rows_without_id_keep_one_of_a_component(docs):
    """Copies of a row with an id go; of a group without any id one row stays."""
    rows = [(1, "alpha beta gamma delta"), (None, "Alpha beta gamma delta"), (None, "one two three four five"),
            (None, "one two three four five"), (None, "ONE two three four five"), (None, "another text altogether, far away")]
    got = [(r.doc_id, r.text) for r in sd.deduplicate(docs(rows)).collect()]
    assert sorted(got, key=str) == sorted([rows[0], rows[4], rows[5]], key=str)


def test_registered_query_on_whole_table(spark):
    base = "/root/testdata/sf0.01"
    rows = QUERIES["op9_simhash_dedup"](spark, base).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    prints = {i: sd.fingerprint(t or "") for i, t in texts.items()}
    assert all(prints[i] == brute_fingerprint(texts[i]) for i in list(texts)[:60])
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows} == prints
    assert {r.doc_id: r.component_id for r in rows} == brute_components(prints)
