import pytest

from dialoom.llm import lookalike as L

NORMAL = ["The crew cheered \U0001f469‍\U0001f680.", "“at last”, he said — well…", "「はい」！", "café", "The seal reads «Свет» now.", "Sector α-8 is silent.", "a  b", "x�y", "❤️", "Hello world", "タ力をの力"]
ODD = [("Ｈello", "Hello"), ("Hel​lo", "Hello"), ("He said so", "He said so"), ("café", "café"), ("Hеllo", "Hello"), ("ﬁve", "five"), ("北⾨", "北門"), ("ｼｷﾗ", "シキラ"), ("Тhe", "The"), ("a‍b", "ab"), ("シ夕ラ", "シタラ")]


def forms(spark, values, repeat=1):
    rows = [(str(k), v, None, "clash") for k, v in enumerate(values)] * repeat
    df = spark.createDataFrame(rows, "key string, text string, speaker string, value string")
    return {int(r.key): r.normal for r in L.normal_forms(df, ["key"], ["speaker", "text"]).collect()}


def test_normal_values_stay(spark):
    assert forms(spark, NORMAL) == {}


def test_odd_values_change(spark):
    values = [a for a, _ in ODD]
    assert forms(spark, values) == {k: b for k, (_, b) in enumerate(ODD)}


def test_frequency_decides_about_whole_words(spark):
    # a Cyrillic а alone is the article where the plain one is frequent, and a word of its own where it is not
    assert forms(spark, ["I have а dog"] + ["I have a cat"] * 3) == {0: "I have a dog"}
    assert forms(spark, ["Α-21 is silent", "Α-21 again"]) == {}


def test_edges(spark):
    assert forms(spark, []) == {}
    long = "word " * 30_000 + "Hеllo"
    assert forms(spark, [None, "", long, long], repeat=2) == {2: long.replace("Hеllo", "Hello"), 3: long.replace("Hеllo", "Hello")}


def test_union_find():
    u = L.UnionFind()
    for a, b in (("c", "b"), ("b", "a"), ("x", "y")):
        u.union(a, b)
    assert (u.find("c"), u.find("y"), u.find("lone")) == ("a", "x", "lone")


@pytest.mark.parametrize("word, expected", [("Βróthоdrun", "Bróthodrun"), ("Свет", None), ("Сwет", "Сԝет"), ("plain", None), ("キー姫", None)])
def test_forced(word, expected):
    assert L.forced(word) == expected or L.forced(word) == word


def test_rewriter_takes_whole_words_only():
    assert L.Rewriter({"Hеllo": "Hello"})("Hеllo, Hеllos") == "Hello, Hеllos"
    assert L.Rewriter({})("x") == "x"


def test_idempotent():
    for value, normal in ODD:
        assert L.plain_points(L.plain_points(value)) == L.plain_points(value) and L.plain_points(normal) == normal
