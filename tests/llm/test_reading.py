import random

import pytest

from dialoom.llm import reading as R

EASY = "the cat sat on a mat and ran to see the dog by the old red barn".split()
HARD = "jurisdictional correspondence irreconcilable notwithstanding circumvented inauguration metaphysical cartography substantiated".split()
EASY_ZH, HARD_ZH = ["我们", "看见", "小船", "旧的", "钥匙", "他们", "找到", "鱼"], ["僭越", "裁断", "斡旋", "谱系", "渊源", "审慎", "缔结", "盟誓"]


def document(rng, level, chinese):
    easy, hard = (EASY_ZH, HARD_ZH) if chinese else (EASY, HARD)
    share, length = (0.02, 0.25, 0.45, 0.7)[level - 1], (6, 9, 14, 22)[level - 1]
    blank, stop, comma = ("", "。", "，") if chinese else (" ", ". ", ", ")
    out = ""
    for _ in range(12):
        words = [rng.choice(hard if rng.random() < share else easy) for _ in range(length)]
        out += blank.join(w + (comma.strip() if k and k % 7 == 0 else "") for k, w in enumerate(words)) + stop
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    rng, docs, labels = random.Random(2), [], []
    for k in range(900):
        level = k % 4 + 1
        docs.append((k, document(rng, level, k % 3 == 0), None if k % 50 == 7 else "zh" if k % 3 == 0 else "en", level, "clash"))
        if k // 4 % 2:
            labels.append((k, "r1", min(4, max(1, level + rng.choice([0, 0, 0, 0, 0, 1, -1])))))
    labels += [(5, "r2", None), (7, "r2", 9), (10_000, "r1", 2)]
    return (spark.createDataFrame(docs, "doc_id bigint, text string, lang string, truth int, level string"), spark.createDataFrame(labels, "doc_id bigint, rater string, level int"))


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    truth = {r.doc_id: r.truth for r in docs.collect()}
    got = {r.doc_id: r.level for r in R.reading_levels(docs, labels).collect()}
    held_out = [k for k in truth if k // 4 % 2 == 0]
    assert set(got) == set(truth)
    assert sum(got[k] == truth[k] for k in held_out) >= 0.9 * len(held_out)


def test_edges(spark, corpus):
    docs, labels = corpus
    rows = [(1, None, "en"), (2, "", "en"), (3, " " * 200, "en"), (4, "short", "en"), (5, "the cat sat. " * 20_000, None), (6, "好" * 100, "xx"), (6, "好" * 100, "xx"), (None, "the cat sat on the mat. " * 9, "en")]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = R.reading_levels(docs.select("doc_id", "text", "lang").filter("doc_id > 100").unionByName(odd), labels)
    found = {}
    for r in got.filter("doc_id is null or doc_id < 100").collect():
        found.setdefault(r.doc_id, []).append(r.level)
    assert set(found) == {None, 3, 5, 6} and len(found[6]) == 2
    assert all(1 <= x <= 4 for xs in found.values() for x in xs)
    assert R.reading_levels(odd.limit(0), labels).count() == 0
    assert [r.level for r in R.reading_levels(odd.filter("doc_id = 5"), labels.limit(0)).collect()] == [None]


def test_vocabulary_ranks_follow_frequency(spark):
    docs = spark.createDataFrame([(1, "b b b a a Anna Anna Anna Anna c", "en"), (2, "你好你好世界", "zh")], "doc_id bigint, text string, lang string")
    got = {(r.lang, r.word): r["rank"] for r in R.vocabularies(docs).collect()}
    assert got[("en", "b")] == 0 and got[("en", "a")] == 1 and got[("en", "c")] == 2 and ("en", "anna") not in got
    assert got[("zh", "你好")] == 0


def test_words_outside_the_vocabulary_count_but_names_do_not(spark):
    docs = spark.createDataFrame([(1, "the the the cat cat sat Anna Anna " * 9 + "perspicacious well-known", "en")], "doc_id bigint, text string, lang string")
    words = R.word_counts(docs)
    ranks = R._Ranks(["the", "cat"], R.name_marks(words)["en"])
    found, *_, letters, long, seen = R._spaced("the Anna cat perspicacious cat/the. annA", ranks)
    assert found.tolist() == [0, 1, 2, 1, 0] and letters == (4 * 3 + 13) / 5 and long == 1 / 5 and seen == 4 / 7
    x = {r.doc_id: r.x for r in R.document_features(docs, R.vocabularies(docs, size=2), names=R.name_marks(words)).collect()}
    assert x[1][0] < x[1][5] == pytest.approx(1.0986122886681098)  # log1p of rank 2, behind the vocabulary


def test_texts_without_language_are_counted(spark):
    rows = [(1, "the cat sat on the mat " * 5, "en"), (2, "el gato duerme en la casa " * 5, "es"), (3, "the cat saw on the mat one marmalade", None), (4, "gato", None)]
    got = {(r.lang, r.word): r["rank"] for r in R.vocabularies(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert ("en", "marmalade") in got and ("es", "marmalade") not in got and got[("es", "gato")] == 0
    alone = R.vocabularies(spark.createDataFrame(rows[2:], "doc_id bigint, text string, lang string"))
    assert {r.lang for r in alone.collect()} == {""}


def test_a_text_of_very_many_pieces():
    ranks = R._Ranks(["a"])
    text = " ".join(f"{k:x}z" for k in range(400_010))
    for _ in range(2):
        assert R._features(text, ranks)[1] < 1
