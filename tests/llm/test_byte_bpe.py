import os
import random

import pytest
from pyspark.sql import functions as F

from strandline.llm.byte_bpe import PrefixEncoder, token_count, token_ids, vocabulary_path

HF = vocabulary_path(name="byte_bpe_50k.json")
pytestmark = pytest.mark.skipif(not os.path.exists(vocabulary_path()), reason="no vocabulary files")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(HF)
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def encoder():
    return PrefixEncoder(vocabulary_path())


def test_random_texts(encoder, reference):
    rng = random.Random(1)
    parts = ["a", "b", "e", "t", "th", "er", "ing", " ", "  ", "é", "é", "漢", "字", "‍", "'s", "12", "__", "<|endoftext|>", "\n", "\t", "　", "İ", "ß", "🧨", "\x00", "\x85", "\xa0", "A", "Z", "...", "ﬁ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 80))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0xD7FF), rng.randrange(0x10000, 0x1FFFF)])) for _ in range(40)) for _ in range(500)]
    assert [encoder.encode(t) for t in texts] == reference(texts)


def test_long_pieces(encoder, reference):
    rng = random.Random(2)
    texts = ["a" * 20_000, "_" * 5001, "ab" * 4000, " " * 3000, "の" * 4000, "".join(rng.choice("abcdefghij") for _ in range(20_000)), "the" * 5000 + " end"]
    assert [encoder.encode(t) for t in texts] == reference(texts)


def test_ids_decode_to_the_text(encoder):
    text = "Überraschung <|endoftext|> 津波 \t\n x" * 50
    assert b"".join(encoder.token[i] for i in encoder.encode(text)).decode() == text


def test_columns(spark, encoder, reference):
    rows = [(1, None), (2, ""), (3, " "), (4, "port closed"), (4, "port closed"), (5, "x" * 70_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = sorted(tuple(r) for r in df.select("doc_id", token_ids(F.col("text")).alias("t"), token_count(F.col("text")).alias("n")).collect())
    want = sorted((i, [] if not t else reference([t])[0], 0 if not t else len(reference([t])[0])) for i, t in rows)
    assert got == want
    assert df.limit(0).select(token_ids(F.col("text"))).count() == 0
