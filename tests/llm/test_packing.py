import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from strider.llm import packing
from strider.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute_first_fit(sizes, capacity):
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for b in bins:
            if sum(sizes[j] for j in b) + sizes[i] <= capacity:
                b.append(i)
                break
        else:
            bins.append([i])
    return bins


def test_tournament_gives_first_fit_decreasing():
    rng = random.Random(3)
    for _ in range(60):
        capacity = rng.choice([8, 100, 1024])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
        assert packing.first_fit_decreasing(sizes, capacity) == brute_first_fit(sizes, capacity)


def check_pieces(pieces, texts, capacity=1024):
    """``texts``: text by doc_id; every id in exactly one piece, sequences gapless, no padding."""
    library = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity and at & (at - 1) == 0


def test_pieces_of_odd_documents(docs):
    texts = {1: "", 2: None, 3: "word " * 5000, 4: "a", 5: "the <|endoftext|> end", None: "no key", 7: "x" * 1023}
    check_pieces(packing.pack(docs(list(texts.items())), PATH, group=3).collect(), texts)
    assert packing.pack(docs([]), PATH).count() == 0
    again = packing.pack(docs([(1, "same"), (1, "same")]), PATH).collect()
    assert sum(p.length for p in again) == 2 * again[0].doc_tokens


def test_registered_query_on_whole_table(spark):
    base = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    check_pieces(QUERIES["op8_packing"](spark, base).collect(), texts)
