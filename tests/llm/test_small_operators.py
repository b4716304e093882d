import hashlib
import random

import numpy as np

from strider.llm import decontaminate, exact_dedup, golomb, preferences, quality_crf
from strider.llm.queries import QUERIES

BASE = "/root/testdata/sf0.01"


# --- Golomb codes, exact dedup ---------------------------------------------------------

def test_golomb_round_trip():
    rng = random.Random(2)
    for n in (0, 1, 2, 500):
        for bits in (3, 20, 64):
            values = np.array(sorted({rng.getrandbits(bits) for _ in range(n)}), np.uint64)
            k, payload = golomb.encode(values)
            assert golomb.decode(len(values), k, payload).tolist() == values.tolist()


def test_exact_dedup_of_odd_rows(docs):
    rows = [(1, "A b"), (5, "a B"), (3, "a b"), (2, None), (4, ""), (None, "z"), (None, "a b"), (6, "É"), (7, "é"),
            (8, "long " * 50000), (9, "LONG " * 50000), (10, "x"), (10, "x")]
    got = exact_dedup.duplicates(docs([(*r, i) for i, r in enumerate(rows)], ", kept int")).collect()
    assert len(got) == len(rows)
    want = {1: 5, 5: 5, 3: 5, 2: 4, 4: 4, 6: 6, 7: 7, 8: 9, 9: 9, 10: 10}
    for r in got:
        if r.doc_id is not None:
            assert r.keep_id == want[r.doc_id] and r.kept == (r.doc_id == r.keep_id)
    assert {r.group_size for r in got if r.keep_id == 5} == {4}
    assert next(r for r in got if r.doc_id == 4).text_sha256 == hashlib.sha256(b"").hexdigest()
    assert exact_dedup.duplicates(docs([])).count() == 0
    assert sorted(r.doc_id or -1 for r in exact_dedup.deduplicate(docs(rows)).collect()) == [-1, 4, 5, 6, 7, 9, 10]


# --- preferences -----------------------------------------------------------------------

def test_preferences_share_one_prompt(spark):
    turn = "array<struct<role:string,text:string>>"
    u, a, b = ("user", "hi"), ("assistant", "yes"), ("assistant", "no")
    rows = [(1, [u, a, u, a], [u, a, u, b]), (2, [u, a], [u, a]), (3, [a], [b]), (4, None, [u]), (5, [], []),
            (6, [u, a, u], [u, a]), (7, [("user", None)], [("user", None), a])]
    got = {r.pair_id: r for r in preferences.preferences(
        spark.createDataFrame(rows, f"pair_id long, chosen {turn}, rejected {turn}")).collect()}
    assert got[1].prompt_turns == 3 and got[1].prompt.count("<|user|>") == 2
    assert got[1].chosen == "<|assistant|>\nyes\n"
    for r in got.values():
        for side, mask in ((r.chosen, r.chosen_mask), (r.rejected, r.rejected_mask)):
            spans = [tuple(map(int, s.split(":"))) for s in mask.split(",") if s]
            assert all(side[s:e] in ("yes\n", "no\n") for s, e in spans)
            assert len(spans) == side.count("<|assistant|>")
    assert (got[2].chosen, got[2].rejected, got[2].prompt_turns) == ("", "", 2)
    assert got[4].prompt_turns == 0 and got[5].prompt == "" and got[6].rejected == "" and got[3].prompt == ""


def test_conversations_of_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, None, None), (None, 3, "user", "x"),
            (0, None, "assistant", "long " * 40000)]
    turns = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, turns int")
    got = {r.pair_id: r for r in preferences.preferences(preferences.swapped_replies(turns)).collect()}
    assert set(got) == {0, 1, 2, None}
    assert got[1].prompt_turns == 2 and got[1].rejected.startswith("<|assistant|>\nlong long")
    assert got[2].rejected == "<|assistant|>\n\n" and got[None].prompt_turns == 1
    assert preferences.preferences(preferences.swapped_replies(turns.limit(0))).count() == 0


# --- decontamination -------------------------------------------------------------------

def edits(item, text):
    """Least edits of the item anywhere in the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_items_within_the_edit_budget_are_found(spark, docs):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(12)) for i in range(8)] + [(8, "short"), (None, text(12)), (9, None), (10, text(12))]
    rows = []
    for d in range(60):
        own = text(rng.randrange(30))
        if d % 2:
            part = list(items[d % 8][1])
            for _ in range(rng.randrange(0, 9)):
                at = rng.randrange(len(part))
                part[at:at + rng.randrange(2)] = rng.choice(["", "x", "yz"])
            own += " " + "".join(part).upper() + "\n" + text(3)
        rows.append((d, own))
    rows += [(100, None), (101, ""), (102, text(9000)), (None, items[0][1]), (0, rows[0][1])]
    benchmark = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, edits int")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.contaminated(docs(rows), benchmark).collect()}
    for d, t in rows:
        data = decontaminate.normalised(t or "").decode()
        for i, item in items[:8]:
            budget = decontaminate.edit_budget(len(item))
            if len(data) < 3000:
                least = edits(item, data)
                assert ((d, i) in got) == (least <= budget), (d, i, least, budget)
                assert got.get((d, i), least) == least
    kept = [r.doc_id for r in decontaminate.clean(docs(rows), benchmark).collect()]
    assert sorted(map(str, kept)) == sorted(str(d) for d, _ in rows if not any(x == d for x, _ in got))
    assert decontaminate.contaminated(docs([]), benchmark).count() == 0
    assert decontaminate.contaminated(docs(rows), benchmark.limit(0)).count() == 0
    assert decontaminate.clean(docs(rows), benchmark.limit(0)).count() == len(rows)


def test_items_without_id_and_short_items_are_found(spark, docs):
    rows = [(1, "the CAT sat"), (2, "concatenate to  bed"), (3, "or to\nBe?  To be"), (4, "A question nobody has asked, here"),
            (5, "nothing"), (6, None), (None, "cat"), (7, "a question nobody has ever answered")]
    items = [(1, "Cat"), (2, " to be"), (None, "question nobody has asked"), (3, " "), (4, None), (9, "cat"), (None, "sat")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits, r.end, r.item_chars) for r in decontaminate.contaminated(docs(rows), benchmark).collect()}
    assert got == {(1, 1, 0, 7, 3), (1, 9, 0, 7, 3), (1, None, 0, 11, 3), (3, 2, 0, 15, 5), (4, None, 0, 27, 25),
                   (None, 1, 0, 3, 3), (None, 9, 0, 3, 3)}
    assert sorted(r.doc_id for r in decontaminate.clean(docs(rows), benchmark).collect()) == [2, 5, 6, 7]


def test_frequent_grams_are_counted_in_steps(monkeypatch):
    rng = random.Random(7)
    phrase = b"which of the following statements is right "
    words = [bytes(rng.choices(b"abcdef", k=5)) for _ in range(40)]
    items = [(i, phrase + b" ".join(rng.choices(words, k=8))) for i in range(10)] + [(10, b"a" * 60)]
    texts = [(phrase * 6 + t + b" " + phrase * 2).decode() for _, t in items[:6]] + ["a" * 200, phrase.decode() * 20]
    whole = list(decontaminate.Index(items).hits(texts))
    assert {(d, i) for d, i, *_ in whole} >= {(d, d) for d in range(6)} | {(6, 10)}
    for step in (1, 37, 5000):
        monkeypatch.setattr(decontaminate, "ENTRIES", step)
        assert list(decontaminate.Index(items).hits(texts)) == whole


def test_whole_items_in_documents_are_found(spark):
    found = {(r.doc_id, r.item_id) for r in QUERIES["op6_decontaminate"](spark, BASE).collect()}
    items = [(r.item_id, decontaminate.normalised(r.text)) for r in spark.read.parquet(f"{BASE}/benchmark.parquet").collect()]
    held = {(r.doc_id, i) for r in spark.read.parquet(f"{BASE}/documents.parquet").collect()
            for i, t in items if t in decontaminate.normalised(r.text or "")}
    assert held and held <= found
    assert len(found) <= len(held) + 2


# --- quality ---------------------------------------------------------------------------

def brute_marginals(emission, step):
    """P(good) by summing over all labellings."""
    n = len(emission)
    total, good = 0.0, np.zeros(n)
    for code in range(1 << n):
        y = [code >> i & 1 for i in range(n)]
        w = np.exp(sum(emission[i] for i in range(n) if y[i]) + sum(step[a, b] for a, b in zip(y, y[1:])))
        total += w
        good += w * np.array(y)
    return good / total


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    step = rng.normal(size=(2, 2))
    chains = [rng.normal(size=n) for n in (1, 2, 5, 8, 1, 7)]
    for got, emission in zip(quality_crf.marginals(chains, step), chains):
        assert np.allclose(got, brute_marginals(emission, step))


def test_scores_of_odd_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, "plain text."), (4, "a | b | c | d\n" * 20000), (4, "again"), (5, "x" * 100000)]
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, 0), (4, 1), (5, 0), (2, None), (None, 1)], "doc_id long, quality int")
    table = docs([(*r, 0.0) for r in rows], ", score double")
    model = quality_crf.fit(table, labels)
    got = quality_crf.score(table, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert quality_crf.score(docs([]), quality_crf.fit(docs([]), labels.limit(0))).count() == 0
    kept = quality_crf.accepted(table, model)
    assert kept.columns == table.columns
    assert kept.count() == sum(r.predicted for r in got)
