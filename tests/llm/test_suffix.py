import hashlib
import random

import numpy as np
import pytest

from strider.llm import difference_cover as dc
from strider.llm import suffix_dedup as sd
from strider.llm import text_blocks
from strider.llm.queries import QUERIES


@pytest.mark.parametrize("prefix", [4, 12, 50])
def test_classes_equal_prefix_equality(prefix):
    rng = random.Random(prefix)
    for letters in ("a", "ab", "abcdefgh"):
        for n in (prefix, prefix + 1, 300, 1000):
            text = "".join(rng.choice(letters) for _ in range(n))
            text = (text + text[n // 3:] + "b" * prefix + text[:n // 2]).encode()
            data = np.frombuffer(text, np.uint8)
            starts = np.array([i for i in range(len(text) - prefix + 1) if rng.random() < 0.8] or [0])
            got = dc.prefix_classes(data, starts, prefix)
            want: dict = {}
            for i, c in zip(starts.tolist(), got.tolist()):
                want.setdefault(text[i:i + prefix], set()).add(c)
            assert all(len(v) == 1 for v in want.values())
            assert len(set(got.tolist())) == len(want)


def test_order_is_by_prefix():
    rng = random.Random(9)
    text = bytes(rng.choice(b"abc") for _ in range(2000))
    order = dc.sorted_suffixes(np.frombuffer(text, np.uint8), 27)
    prefixes = [text[i:i + 27] for i in order.tolist()]
    assert prefixes == sorted(prefixes) and sorted(order.tolist()) == list(range(2000))


def brute(rows, size):
    data = [(i, (t or "").encode()) for i, t in rows]
    low: dict = {}
    for i, t in data:
        if i is not None:
            for s in range(len(t) - size + 1):
                k = t[s:s + size]
                low[k] = min(low.get(k, i), i)
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        if i is not None:
            for s in range(len(t) - size + 1):
                if low[t[s:s + size]] < i:
                    gone[s:s + size] = b"\1" * size
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def answers(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [6, 20, 50])
def test_against_brute_force(docs, size, monkeypatch):
    rng = random.Random(size)
    passage = "".join(rng.choice("abcdefgé ") for _ in range(300))
    rows = []
    for d in range(50):
        text = "".join(rng.choice("abcdefghijkl \n") for _ in range(rng.randrange(400)))
        for _ in range(rng.randrange(3)):
            a = rng.randrange(250)
            text = text[:40] + passage[a:a + rng.randrange(150)] + text[40:]
        rows.append((rng.randrange(1000) - 300, text))
    rows += [(2000, rows[3][1]), (-999, rows[3][1]), (2001, "x" * 500), (2002, "x" * 400 + "y"), (2003, None),
             (2004, ""), (None, rows[4][1]), (None, passage), (rows[3][0], rows[3][1]), (2005, rows[5][1][:60])]
    rows += [(3000 + i, rows[6][1]) for i in range(30)]
    monkeypatch.setattr(text_blocks, "BLOCK_BYTES", 2000)
    assert answers(sd.repeated_bytes(docs(rows), size)) == brute(rows, size)


def test_empty_table_and_short_texts(docs):
    assert sd.repeated_bytes(docs([])).count() == 0
    rows = [(1, "short"), (2, "short"), (2, None)]
    assert answers(sd.repeated_bytes(docs(rows))) == brute(rows, 50)


def test_registered_query_on_whole_table(spark):
    base = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{base}/documents.parquet").collect()]
    got = answers(QUERIES["op10_suffix_dedup"](spark, base))
    assert got == brute(rows, 50) and sum(r[2] for r in got) > 0


def test_line_of_many_documents_is_split(docs, monkeypatch):
    """A line in other words everywhere: no anchor brings an owner more than the limit."""
    limit, rng = 4000, random.Random(4)
    prose = lambda n: "".join(rng.choice("abcdefghijklmnopqrst ") for _ in range(n))
    line, rows = prose(120), []
    for d in range(240):
        rows.append((d, prose(100) + line + prose(100)))
    rows += [(300 + d, prose(50) + rows[3 * d][1][60 + d:270 - d] + prose(50)) for d in range(40)]
    monkeypatch.setattr(text_blocks, "BLOCK_BYTES", 8000)
    monkeypatch.setattr(sd, "HOT_BYTES", limit, raising=False)
    real = sd._sort

    def checked(size):
        run = real(size)

        def sort(key, rows):
            seen = {}
            for sizes, anchors, payload in zip(rows["sizes"], rows["anchors"], rows["payload"]):
                at = 0
                for n, a in zip(np.frombuffer(sizes, "<u4").tolist(), np.frombuffer(anchors, "<u4").tolist()):
                    seen.setdefault(a, set()).add(payload[at:at + n])
                    at += n
            assert max(sum(map(len, s)) for s in seen.values()) < limit
            return run(key, rows)
        return sort

    monkeypatch.setattr(sd, "_sort", checked)
    assert answers(sd.repeated_bytes(docs(rows))) == brute(rows, 50)


def test_sorting_in_steps(monkeypatch):
    rng = random.Random(7)
    pairs = {(a, bytes(rng.choice((a, a + 32)) for _ in range(rng.randrange(6, 20)))) for a in range(65, 85) for _ in range(15)}
    anchors, snippets = np.array([a for a, _ in sorted(pairs)]), [s for _, s in sorted(pairs)]
    rank = np.array([rng.randrange(50) for _ in snippets])
    want: dict = {}
    keys = [(a, s[i:i + 6]) for a, s in zip(anchors.tolist(), snippets) for i in range(len(s) - 5)]
    for k, r in zip(keys, np.repeat(rank, [len(s) - 5 for s in snippets]).tolist()):
        want[k] = min(want.get(k, r), r)
    held = []
    real = sd.prefix_classes
    monkeypatch.setattr(sd, "prefix_classes", lambda data, *rest: held.append(len(data)) or real(data, *rest))
    monkeypatch.setattr(sd, "SORT_BYTES", 500, raising=False)
    assert sd.earliest(snippets, anchors, rank, 6)[0].tolist() == [want[k] for k in keys]
    assert len(held) > 3 and max(held) <= 500
