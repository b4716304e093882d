import random

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from strider.llm import token_counts
from strider.llm.queries import QUERIES
from strider.llm.tokens import Vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", " ", "don't we're I'll 'twas x'r y'l  'sa", "a   b\n\n c\n\n\nd \t e's", "<|endoftext|>",
         "ab<|endoftext|>  <|endoftext|>cd<|endoftext|", "hello world 12345   x　　y",
         "éàç ñ 你好世界 😀😀", "!!!'s ...'re\n's \n's\t't ' s", "word " * 900]


@pytest.fixture(scope="module")
def vocab():
    return Vocabulary(PATH)


def test_every_prefix_count_matches_the_library(vocab):
    library = Tokenizer.from_file(PATH)
    rng = random.Random(1)
    letters = [*"ab 's\n\tre'lé1!<|>你  ", "<|endoftext|>", "the", "ing"]
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    for text in TEXTS[:-1] + made:
        steps, total = vocab.steps(text)
        expected = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]
        assert np.cumsum(np.frombuffer(steps, np.int8)).tolist() == expected
        assert total == (expected[-1] if expected else 0)
        assert vocab.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_prefix_counts_where_unicode_tables_differ(vocab):
    library = Tokenizer.from_file(PATH)
    cut = library.pre_tokenizer.pre_tokenize_str
    rare = [c for c in map(chr, [*range(0xA0, 0xD800), *range(0xE000, 0x32000, 7)])
            if regex.match(r"\p{L}", c) and len(cut("a" + c)) > 1 or c.isspace() != bool(regex.match(r"\s", c))
            or not regex.match(r"[\p{L}\p{N}\s]", c) and len(cut("!" + c)) > 1]
    assert rare
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice([*"ab 's1.\n", "é", "你", "\x1c", "the", " the", "'re", "<|endoftext|>", rng.choice(rare), rng.choice(rare)])
                       for _ in range(rng.randint(1, 25)))
        steps, total = vocab.steps(text)
        expected = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]
        assert np.cumsum(np.frombuffer(steps, np.int8)).tolist() == expected and total == expected[-1]


def test_table_answers_budget_questions(spark, docs, vocab):
    rows = [*enumerate(TEXTS), (None, "no key"), (3, None), (3, None)]
    table = token_counts.prefix_counts(docs(rows).withColumnRenamed("text", "body"), PATH, text="body")
    got = {(r.doc_id, r.n_bytes): r for r in table.withColumn("fit", token_counts.fitting_prefix("steps", 512)).collect()}
    assert len(got) == len(rows) - 1           # the repeated row is there twice, with one answer
    long = got[9, 4500]
    assert long.n_tokens > 512
    assert token_counts.tokens_before(long.steps, long.fit) <= 512 < token_counts.tokens_before(long.steps, long.fit + 1)
    assert got[3, 0].n_tokens == 0 and got[3, 0].fit == 0
    assert table.limit(0).count() == 0


def test_registered_query_on_whole_table(spark):
    library = Tokenizer.from_file(PATH)
    base = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op5_token_counts"](spark, base).collect()}
    docs = spark.read.parquet(f"{base}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        n = len(library.encode(d.text or "", add_special_tokens=False).ids)
        assert (got[d.doc_id].n_tokens, got[d.doc_id].n_bytes, got[d.doc_id].over_limit) == (
            n, len((d.text or "").encode()), n > 512)
