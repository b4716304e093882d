import hashlib
import re

from strider.llm import pii
from strider.llm.queries import QUERIES

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                  "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                  "phone": lambda: 8 <= len(digits) <= 15}[kind]()
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def check(rows, texts):
    for r in rows:
        want = brute(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (r.doc_id, r.spans, listed)
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
        for kind in BASE:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in want)
        order = [(list(BASE).index(s.split(":")[0]), int(s.split(":")[1])) for s in r.spans.split(",") if s]
        assert order == sorted(order)


TEXTS = {
    1: "write a@b.c_d@e.f x a@b.cd a@b.c é😀 mail: joe.x+1@mail.example.com.", 2: None, 3: "", 4: "1.2.3.4.5 1.2.3.256 300.1.1.1 001.02.3.4 0.0.0.0",
    5: "4539 1488 0343 6467 and 4539148803436468 4539-1488-0343-6467", 6: "+1 (517) 555-0938 +1--- +12 +123456789012345678",
    7: "call (517) 555-0938 or phone 517-555-0938; joe (at) mail (dot) example (dot) com; email bob [at] host.org",
    8: "x" * 2000 + "@" + "1" * 500 + " 12.3", 9: "a.a." * 200 + "@b" + ".c" * 300, 10: "+1" + " " * 20000 + "x 1@2.3",
    11: "call 517.555.0938 tel 212-555-0147", 12: "$1 \\2 (at) 1234/5678/1234/5670",
}


def test_base_spans_match_the_plain_patterns(docs):
    got = pii.find(docs(list(TEXTS.items()))).collect()
    assert len(got) == len(TEXTS)
    check(got, TEXTS)


def test_loose_spans_are_added_and_clean_text_left(docs):
    clean = {100 + i: f"plain words only, item {i}" for i in range(20)}
    got = {r.doc_id: r for r in pii.find(docs([*TEXTS.items(), *clean.items()])).collect()}
    assert got[7].n_added >= 1
    assert all(got[i].spans == "" for i in clean)


def test_very_long_runs_are_scanned_in_linear_time(docs):
    got = {r.doc_id: r for r in pii.find(docs([
        (1, "x" * 200000 + "@" + "1" * 50000 + " 12.3"), (2, "a.a." * 20000 + "@b" + ".c" * 30000),
        (3, "1" * 100000 + ".1.1"), (4, "1 " * 50000), (5, "1.1.1.1 " * 3000)])).collect()}
    assert [got[i].spans for i in (1, 3, 4)] == [""] * 3
    assert got[2].spans == f"email:0:{80002 + 60000}"
    assert got[5].n_ip == 3000 and got[5].spans.endswith("ip:23992:23999")


def test_repeated_rows_null_keys_and_empty_table(docs):
    got = pii.find(docs([(1, "a@b.c"), (1, "a@b.c"), (None, "+1 222 333 444")])).collect()
    assert sorted(r.spans for r in got) == ["email:0:5", "email:0:5", "phone:0:14"]
    assert pii.find(docs([])).count() == 0


def test_main_path_has_no_python(docs):
    plan = pii.find(docs([(1, "a@b.c")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)


def test_registered_query_on_whole_table(spark):
    base = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    rows = QUERIES["op2_pii"](spark, base).collect()
    assert {r.doc_id for r in rows} == set(texts)
    check(rows, texts)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 20


def test_many_matches_take_time_in_proportion(docs):
    """Numbers throughout: 1 MB within a minute, and at most three times as long as half of it."""
    import time
    took = []
    for half in (1, 2):
        start = time.perf_counter()
        row = pii.find(docs([(1, "12, " * 125_000 * half + "1.2.3.4 (517) 555-0938")])).collect()[0]
        took.append(time.perf_counter() - start)
        at = 500_000 * half
        assert row.n_ip == 1 and f"ip:{at}:{at + 7}" in row.spans
    assert took[1] < 60 and took[1] < 3 * took[0] + 2


def test_loose_spans_that_meet_base_spans_go(spark):
    """Random spans of two kinds against a comparison of every pair, with more than one block."""
    import random
    from pyspark.sql import functions as F
    rng, rows = random.Random(5), []
    for i in range(60):
        spans = []
        for _ in range(2):
            got = []
            for kind in (0, 2):
                at = 0
                for _ in range(rng.choice([0, 1, 3, 40, 400])):
                    at += rng.choice([0, 0, 1, 7])
                    end = at + rng.choice([1, 2, 9, 60])
                    got.append((kind, at, end))
                    at = end
            spans.append(got)
        rows.append((i, *spans))
    kind = "array<struct<kind:int,start:int,end:int>>"
    table = spark.createDataFrame(rows, f"id int, base {kind}, loose {kind}")
    for r in table.select("id", pii._apart(F.col("loose"), F.col("base")).alias("left")).collect():
        base, loose = rows[r.id][1:]
        want = [c for c in loose if not any(b[0] == c[0] and b[1] < c[2] and c[1] < b[2] for b in base)]
        assert [tuple(c) for c in r.left] == want
