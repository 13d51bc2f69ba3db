import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dialoom.llm import tokens

PATH = os.path.join(tokens.TOKENIZER_DIR, "byte_bpe_50k.json")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary")
TEXTS = ["", None, "a", "  ", "   a", "a   ", "\n \n a", "foo \n\n  bar  ", "aaaaaaaaaaa", "don't  I'll 's", "x\t y 　 z", "<|endoftext|> hi", "你好，世界！\n再见", "フィカタ・ロルタノ", "é́ 👩‍🚀", "a b " * 9000, "好" * 5000]


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encode():
    return tokens.tokenizer_callable()


def test_texts(reference, encode):
    for text in TEXTS:
        assert encode(text) == reference(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'’.,09aAbzé好のッ👩‍"), st.characters(codec="utf-8")), max_size=60))
def test_any_text(reference, encode, text):
    assert encode(text) == reference(text)


def test_small_pool_gives_the_same(reference):
    encoder = tokens.Encoder(tokens.Merges(PATH), pool_ids=10)
    for text in TEXTS[:15]:
        assert encoder.encode([text])[0].tolist() == reference(text)


def test_table(spark, reference):
    rows = [(k, t, "en", [1]) for k, t in enumerate(TEXTS)] + [(None, "null id", None, None), (0, "", "en", None), (0, "", "en", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, key string, ids array<int>")
    got = [(r.doc_id, r.ids) for r in tokens.encode_corpus(df).collect()]
    assert sorted(got, key=str) == sorted([(k, reference(t)) for k, t, *_ in rows], key=str)
    counted = tokens.count_tokens(df.select("doc_id", "text")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in counted) == sorted((k is None, k or 0, len(reference(t))) for k, t, *_ in rows)
    assert tokens.encode_corpus(df.limit(0)).collect() == []
