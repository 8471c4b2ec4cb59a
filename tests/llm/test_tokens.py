import random

import pytest

from millrace.llm import tokens
from tests.conftest import rows

LINES = open(f"{tokens.TOKENIZER_DIR}/{tokens.BYTE_BPE_50K}", "rb").read()


@pytest.fixture(scope="module")
def library():
    tok = pytest.importorskip("tokenizers")
    t = tok.Tokenizer.from_file(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


TEXTS = [
    "", " ", "   \n\n \t", "Hello, world! It's 2025.", "<|endoftext|>", "a" * 5000, "ab" * 4000 + " zz", "录音" * 700, "é̀" * 300, "👩‍🎤🎸", "x\r\ny z\x00", "I'll we'RE 'S", "１２3",
]


def test_against_library(library):
    e = tokens.Encoder(LINES)
    for t in TEXTS:
        ids = e.encode(t)
        assert ids == library.encode(t, add_special_tokens=False).ids
        back = {v: k for k, v in e.ranks.items()}
        assert b"".join(back[i] for i in ids).decode() == t


def test_long_words_as_short_ones():
    e, rnd = tokens.Encoder(LINES), random.Random(1)
    for _ in range(200):
        w = bytes(rnd.choice(b"abcde THE etaoin\xe9\x88") for _ in range(rnd.randint(1, 80)))
        assert tokens.merge_short(w, e.ranks) == tokens.merge_long(w, e.ranks)


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " ", "x"), (None, "a", "x"), (5, "a b", "x"), (5, "a b", "x")], "doc_id bigint, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_texts(df).collect()}
    assert got[1] == [] and got[2] == [] and got[3] == [220] and got[None] == [64] and got[5] == [64, 275]
    assert tokens.encode_texts(df).count() == 6
    assert rows(tokens.encode_texts(df.limit(0))) == []
    assert [r["tokens"] for r in tokens.count_tokens(df).orderBy("doc_id").collect()] == [1, 0, 0, 1, 2, 2]
