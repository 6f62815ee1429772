import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rostra.llm import token_counts
from rostra.llm.token_counts import KNOWN, Lengths

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    " ", "  ", "\n", "\t", "a", "bc", "é", "!", "1", "\x1c", "\x85", "'s", "'ll", "<|endoftext|>", "日",
    " x", "\r\n", "ab, ", " cd.", "ª", "ⅷ", " ", "😀", "՘", " ", "Ω",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def plain(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_cut_agrees_with_the_tokenizer_on_all_known_characters(tokenizer):
    cut = Lengths(VOCABULARY, {}).cut
    for first, last in KNOWN:
        for code in range(first, last + 1, 1 if last - first < 2000 else 37):
            text = f"a{chr(code)}{chr(code)}1 {chr(code)}"
            spans = [span for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
            assert cut(text) == [text[a:b] for a, b in spans], hex(code)


@pytest.mark.parametrize("remembered", [0, 50, 1_000_000])
def test_counts_of_random_texts(tokenizer, monkeypatch, remembered):
    monkeypatch.setattr(token_counts, "REMEMBERED", remembered)
    rng = random.Random(remembered)
    lengths = Lengths(VOCABULARY, {" x": 1, "a": 1})
    for _ in range(10):
        texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 15))) for _ in range(200)]
        assert lengths.count(pa.array(texts, pa.string())) == [plain(tokenizer, t) for t in texts]


def test_every_document(spark, tokenizer):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["the", "of", "and,", "some.\n", "wörds"], k=rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", "word " * 300_000, "x" * 1_000_000, "7" * 1_000_000, "." * 1_000_000, "<|endoftext|>", "日本 ՘"]
    texts += ["one " * 1024, "one " * 1023 + "one"]
    rows = [(i % 290 if i % 7 else None, t, i, "c") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, piece string").repartition(3)
    found = sorted(map(tuple, token_counts.token_counts(docs).collect()), key=str)
    expected = [
        (d, len((t or "").encode()), plain(tokenizer, t), plain(tokenizer, t) > 1024) for d, t, *_ in rows
    ]
    assert found == sorted(expected, key=str)


def test_empty_table(spark):
    assert token_counts.token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_table_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"word{i} again " + "y" * 50) for i in range(100)], "doc_id long, text string")
    found = token_counts.frequent_pieces(docs, VOCABULARY, size=3)
    assert len(found) == 3 and " again" in found
