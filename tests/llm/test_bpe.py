import random

import pytest
from tokenizers import Tokenizer

from siltstone.llm import bpe
from siltstone.llm.queries import tokenizer_path

ODD = ["", " ", "aaa aaaa aaaaa", "Don't I'LL we've ''s", "ΑΣ ΣΑΣ ς", "İstanbul ǅ", "<|endoftext|>Hi <|startoftext|><|endoftext|> x<|endo", "é café ẛ̣", "日本語 テスト 123 ١٢ Ⅷ ½", "😀👍🏽 a‍b", "\x1c\x1d\x00 \x85\xa0 x", "naïve ﬁ ß ẞ", "thththth inininin", "l" * 3000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def texts():
    rng = random.Random(1)
    words = ["".join(rng.choice("aAéÉ '́s1٣½<|>\n\t ßΣσ日😀#$") for _ in range(50)) for _ in range(200)]
    return ODD + words + ["".join(chr(rng.randrange(0x20, 0x2FF0)) for _ in range(30)) for _ in range(100)]


def test_same_as_the_library(spark, library):
    cases = texts()
    df = spark.createDataFrame([(k, t, "a", 1) for k, t in enumerate(cases)], "doc_id long, text string, ids string, decoded int")
    got = {r.doc_id: r for r in bpe.encode(df, tokenizer_path()).collect()}
    for k, t in enumerate(cases):
        want = library.encode(t, add_special_tokens=False).ids
        assert got[k].ids == want, t
        assert got[k].decoded == library.decode(want, skip_special_tokens=False), t


def test_decode_undoes_encode(spark):
    df = bpe.encode(spark.createDataFrame([(1, "some text, twice"), (2, None), (3, "")], "doc_id long, text string"), tokenizer_path())
    rows = bpe.decode(df.withColumnRenamed("decoded", "shown"), tokenizer_path()).collect()
    assert all(r.shown == r.decoded for r in rows)
    assert bpe.decode(spark.createDataFrame([(None,), ([],), ([-1, None, 10**7],)], "ids array<int>"), tokenizer_path()).collect()[2].decoded == ""


def test_forgetting_words_changes_nothing(library):
    encoder = bpe.Encoder(bpe.Vocabulary(tokenizer_path()), most_words=20)
    for t in ODD * 2:
        ids, ends, _ = encoder.encode([t, "again " + t])
        assert ids[: ends[1]].tolist() == library.encode(t, add_special_tokens=False).ids


def test_empty_table_and_slices(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).collect() == []
    assert list(bpe.chunks([5, 5, 50, 0, 1], 10)) == [(0, 2), (2, 3), (3, 5)]
