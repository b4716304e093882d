import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strider.llm import fingerprints as fp
from strider.llm.queries import QUERIES

WORDS = [f"w{i}" for i in range(400)]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def shingles(text, size=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[max(0, i - size + 1):i + 1]) for i in range(len(words))}


def test_sketch_is_the_smallest_hashes_whatever_the_parts(monkeypatch):
    text = prose(1, 3000) + " " + "again " * 900
    whole = fp.sketch(text)
    assert len(whole) == fp.SIZE and (np.diff(whole.astype(object)) > 0).all()
    monkeypatch.setattr(fp, "PART_WORDS", 37)
    assert (fp.sketch(text) == whole).all()
    assert (fp.sketch(text.upper().replace("W", "w")) == whole).all()
    assert (fp.decode(fp.encode(whole)) == whole).all()


def test_small_texts_are_exact():
    for a, b in [("one two three", "one two four"), ("a b c d e f g", "x b c d e f g"), ("", "a"), (prose(3, 60), prose(3, 40))]:
        x, y, s, t = fp.sketch(a), fp.sketch(b), shingles(a), shingles(b)
        assert fp.distinct_count(x) == len(s)
        assert fp.resemblance(x, y) == pytest.approx(len(s & t) / len(s | t))
        assert fp.containment(x, y) == pytest.approx(len(s & t) / len(s) if s else 1.0)
    assert fp.resemblance(fp.sketch(None), fp.sketch(" \n")) == 1.0
    assert fp.resemblance(fp.sketch(""), fp.sketch("a")) == 0.0


def test_estimates_of_large_texts():
    off = []
    for seed in range(12):
        a, b = prose(seed, 4000), prose(seed + 100, 2000)
        b = a[:len(a) // 2] + " " + b
        x, y, s, t = fp.sketch(a, 512), fp.sketch(b, 512), shingles(a), shingles(b)
        off.append([fp.resemblance(x, y, 512) - len(s & t) / len(s | t), fp.containment(x, y, 512) - len(s & t) / len(s),
                    fp.distinct_count(x, 512) / len(s) - 1])
    assert np.abs(off).max() < 0.12 and np.abs(np.mean(off, axis=0)).max() < 0.03


def test_sketches_merge_over_parts_and_groups(spark):
    rows = [(i, prose(i % 25, 80), None if i % 7 == 0 else f"s{i % 3}") for i in range(200)] + [(900, None, "empty"), (None, "a b", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = fp.merged(fp.fingerprints(docs, by=["source"]), ["source"]).collect()
    assert len(got) == 5
    for r in got:
        hashes = np.concatenate([fp.sketch(t, 10 ** 6) for _, t, s in rows if s == r.source] + [np.empty(0, np.uint64)])
        assert r.fingerprint == fp.encode(np.unique(hashes)[:fp.SIZE])
        assert r.n_shingles == pytest.approx(len(np.unique(hashes)), rel=0.35)
    (one,) = fp.merged(fp.fingerprints(docs), []).collect()
    assert one.fingerprint == fp.encode(np.unique(np.concatenate([fp.sketch(t, 10 ** 6) for _, t, _ in rows]))[:fp.SIZE])
    (none,) = fp.merged(fp.fingerprints(docs.limit(0)), []).collect()
    assert none.n_shingles == 0.0 and fp.merged(fp.fingerprints(docs.limit(0), by=["source"]), ["source"]).count() == 0


def test_compare(spark):
    pairs = spark.createDataFrame([(1, fp.encode(fp.sketch("a b c")), fp.encode(fp.sketch("a b d"))), (2, None, "")],
                                  "n int, left string, right string")
    got = {r.n: r for r in fp.compare(pairs, "left", "right").collect()}
    assert (got[1].resemblance, got[1].containment, got[1].n_union) == (0.5, pytest.approx(2 / 3), 4.0)
    assert (got[2].resemblance, got[2].n_union) == (1.0, 0.0)


def brute_next(rows):
    """Falling key, no key last, ties by hash and text; each with the following row's text."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[2], r[1]))
    return sorted(((k, t, order[(i + 1) % len(order)][1]) for i, (k, t, _) in enumerate(order)), key=str)


def followed(spark, rows, **kwargs):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    tied = [tuple(r) for r in docs.select("doc_id", F.coalesce("text", F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    got = fp.succession(docs, lambda k, a, b: (k, a, b), "doc_id long, text string, following string", **kwargs)
    return sorted((tuple(r) for r in got.collect()), key=str), brute_next(tied)


@pytest.mark.parametrize("range_bytes", [1 << 25, 300])
def test_succession_over_many_ranges(spark, range_bytes):
    rng = random.Random(range_bytes)
    rows = [(rng.randrange(-500, 500) if i % 3 else 77, prose(i % 90, rng.randrange(0, 30))) for i in range(600)]
    rows += [(None, prose(i % 5, 3)) for i in range(200)] + [(5, "same row")] * 50 + [(-1000, None), (2 ** 62, "x" * 200_000)]
    got, want = followed(spark, rows, range_bytes=range_bytes)
    assert got == want


def test_succession_of_one_two_and_no_rows(spark):
    for rows in ([(3, "only")], [(3, "a"), (9, "b")], [(None, "a"), (None, None)], [(4, "a")] * 3):
        got, want = followed(spark, rows)
        assert got == want
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fp.edited_likeness(docs).collect() == [] and "near_next" in fp.edited_likeness(docs).columns


def test_edited_text_and_clashing_columns(docs):
    assert fp.edited("abcdefg", "XY") == "abcdXY" and fp.edited("a", "b") == "a" and fp.edited("", "b") == ""
    assert fp.edited("héé😀", "ß😀z") == "héß😀"
    rows = [(1, "aaaa bb"), (2, None), (3, "one Two three")]
    table = docs(rows).selectExpr("*", "1 AS tie", "2 AS `range`", "'x' AS tail", "3 AS fingerprint")
    got = {r.doc_id: r for r in fp.edited_likeness(table).collect()}
    assert got[3].edited_sha256 == hashlib.sha256(b"one Two").hexdigest() and got[3].n_chars == 13
    assert got[1].edited_sha256 == hashlib.sha256(b"aaaaone").hexdigest()
    assert got[2].n_chars == 0 and got[2].near_edited == 1.0 and got[2].near_next == 0.0


def test_registered_query_on_whole_table(spark):
    base = "/root/testdata/sf0.01"
    texts = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{base}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in QUERIES["op11_fingerprints"](spark, base).collect()}
    assert len(got) == len(texts)
    off = []
    for i, (doc, text) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        edit = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        assert r.fingerprint == fp.encode(fp.sketch(text)) and r.edited_fingerprint == fp.encode(fp.sketch(edit))
        for value, other in ((r.near_edited, edit), (r.near_next, after)):
            s, t = shingles(text), shingles(other)
            off.append(value - (len(s & t) / len(s | t) if s | t else 1.0))
    assert np.abs(off).max() < 0.25 and abs(np.mean(off)) < 0.01
