"""Banded verification against a whole table of costs."""

import random
import time

import pytest

from strider.llm import decontaminate as dc


def whole_table(item, region, budget):
    row = [0] * (len(region) + 1)
    for i, letter in enumerate(item, 1):
        new = [i]
        for j, other in enumerate(region, 1):
            new.append(min(row[j - 1] + (letter != other), row[j] + 1, new[-1] + 1))
        row = new
    best = min(row)
    return (best, row.index(best)) if best <= budget else None


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_same_edits_and_end_as_the_whole_table(letters):
    rng = random.Random(len(letters))
    hits = 0
    for _ in range(1500):
        item = "".join(rng.choices(letters, k=rng.choice([1, 7, 8, 9, 20, 45, 90])))
        inside = list(item)
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(inside) + 1)
            inside[at:at + rng.randrange(2)] = rng.choices(letters, k=rng.randrange(2))
        pad = lambda: "".join(rng.choices(letters, k=rng.randrange(12)))
        region = (pad() + "".join(inside) + pad())[:rng.choice([0, 5, 30, 200])]
        budget = rng.randrange(6)
        want = whole_table(item.encode(), region.encode(), budget)
        assert dc.banded_edits(item.encode(), region.encode(), budget) == want
        hits += want is not None
    assert hits > 300


def test_long_item_with_one_edit_takes_time_in_proportion():
    rng = random.Random(3)
    took = []
    for size in (25_000, 50_000):
        item = bytes(rng.choices(b"abcdefghijklmnop ", k=size))
        region = b"x" * 3000 + item[:size // 2] + b"!" + item[size // 2:] + b"y" * 3000
        start = time.perf_counter()
        assert dc.banded_edits(item, region, dc.edit_budget(size)) == (1, 3000 + size + 1)
        took.append(time.perf_counter() - start)
    assert took[1] < 1 and took[1] < 3 * took[0] + 0.2


def test_long_item_in_a_document(spark):
    rng = random.Random(4)
    item = "".join(rng.choices("abcdefghijklmnop ", k=50_000))
    text = "before " + item[:20_000] + "#" + item[20_001:] + " after"
    docs = spark.createDataFrame([(1, text), (2, "other words " * 9000), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    rows = dc.contaminated(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.edits) for r in rows] == [(1, 7, 1)]
