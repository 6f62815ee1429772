import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.orc as orc
import pytest
from tokenizers import Tokenizer

from rostra.llm.token_files import SpacedEncoder, read_tokens, token_digest, write_tokens

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def encoded(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("seed", range(3))
def test_pieces_are_encoded_like_whole_texts(tokenizer, seed):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "a", "bc", "é", "!", "1", "\x1c", "'s", "<|endoftext|>", "日", " x", "\r\n", "ab, ", " cd.", ",", ".", "ª", "ⅷ", " "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]
    encoder = SpacedEncoder(VOCABULARY, 2)
    for begin in range(0, len(texts), 300):
        group = texts[begin : begin + 300]
        ids, sizes = encoder.encode(pa.array(group, pa.string()))
        found = np.split(ids, np.cumsum(sizes)[:-1])
        assert [f.tolist() for f in found] == [encoded(tokenizer, t) for t in group]


def test_files_and_digest(spark, tokenizer, tmp_path):
    rng = random.Random(1)
    rows = [(i * 3 % 500, " ".join(rng.choices(["the", "of", "and,", "some.\n", "words"], k=rng.randint(0, 60)))) for i in range(500)]
    rows += [(1000, None), (1001, ""), (1002, "word " * 40_000), (7, "a repeated id"), (None, "no id")]
    docs = spark.createDataFrame([(d, t, d, "x") for d, t in rows], "doc_id long, text string, ids long, first string")
    path = str(tmp_path / "tokens")
    write_tokens(docs, path, files=5, stride_rows=1000)
    found = sorted(map(tuple, token_digest(spark, path).collect()), key=lambda r: r[1])
    start, expected = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(encoded(tokenizer, text), "<u4")
        expected.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == expected
    one = read_tokens(spark, path, [3]).collect()
    assert [r.doc_id for r in one] == [3]
    assert "doc_id" in read_tokens(spark, path, [3])._jdf.queryExecution().executedPlan().toString()
    files = sorted(Path(path).glob("*.orc"))
    assert len(files) == 5 and all(orc.ORCFile(f).nstripes >= 1 for f in files)
    ends = [orc.ORCFile(f).read(["doc_id"]).column("doc_id").drop_null().to_pylist() for f in files]
    assert all(a[-1] < b[0] for a, b in zip(ends, ends[1:]))


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    write_tokens(docs, str(tmp_path / "none"), files=2)
    assert token_digest(spark, str(tmp_path / "none")).count() == 0


def test_tasks_give_freed_memory_back(spark, tmp_path, monkeypatch):
    """A worker waits for its next task without the memory of its last one."""
    from rostra.llm import common

    given = str(tmp_path / "given")
    real = common.give_back

    def noted():
        real()
        open(given, "a").write("x")

    monkeypatch.setattr(common, "give_back", noted)
    run = common._giving_back(lambda batches: (b for b in batches))
    batch = pa.record_batch({"x": [1]})
    assert list(run(iter([batch]))) == [batch] and Path(given).read_text() == "x"
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    assert common.map_batches(docs, lambda b: b, "doc_id long, text string").count() == 1


def test_a_known_piece_is_looked_up_once():
    class Counted(dict):
        asked = 0

        def get(self, key):
            self.asked += 1
            return super().get(key)

        def __contains__(self, key):
            self.asked += 1
            return super().__contains__(key)

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

    encoder = SpacedEncoder(VOCABULARY, 2)
    texts = pa.array(["alpha beta gamma beta", "", "gamma  delta "])
    ids, sizes = encoder.encode(texts)
    encoder.known = Counted(encoder.known)
    again, same_sizes = encoder.encode(texts)
    assert ids.tolist() == again.tolist() and sizes.tolist() == same_sizes.tolist()
    assert encoder.known.asked == len({p for t in texts.to_pylist() for p in t.split(" ")})
