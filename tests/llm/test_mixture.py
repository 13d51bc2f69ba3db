import pytest

from dialoom.llm import mixture as M

TARGETS = "source string, target_share double, max_repeats int"


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint, rate double, cap int")


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(k, "big" if k % 10 < 6 else "mid" if k % 10 < 9 else "small", 50 + (k * 7919) % 900, None, None) for k in range(6000)]
    rows += [(90_001, "big", 0, None, None), (90_002, None, 100, None, None), (90_003, "unlisted", 100, None, None), (90_004, "big", None, None, None), (None, "mid", 10, None, None)]
    return docs(spark, rows)


def mixed(corpus, targets, **options):
    got, balance = M.mix(corpus, targets, **options)
    rows = got.collect()
    whole = sum(r.copies * r.n_tokens for r in rows)
    return rows, {s: sum(r.copies * r.n_tokens for r in rows if r.source == s) / whole for s in {r.source for r in rows}}, balance


def test_shares_and_caps(spark, corpus):
    targets = spark.createDataFrame([("big", 0.3, 1), ("mid", 0.4, 2), ("small", 0.25, 4), ("gone", 0.05, 2), (None, 0.1, 1)], TARGETS)
    rows, shares, balance = mixed(corpus, targets)
    assert all(abs(shares[s] - t / 0.95) < 0.002 for s, t in (("big", 0.3), ("mid", 0.4), ("small", 0.25)))
    caps = {"big": 1, "mid": 2, "small": 4}
    assert all(1 <= r.copies <= caps[r.source] and r.n_tokens > 0 for r in rows)
    report = {r.source: r for r in M.share_report(M.mix(corpus, targets)[0], targets).collect()}
    assert report["gone"].actual_share == 0 and abs(report["mid"].actual_share - 0.4 / 0.95) < 0.002


def test_rates_are_the_exponential_tilt(spark, corpus):
    import math

    targets = spark.createDataFrame([("big", 0.5, 3), ("mid", 0.5, 3)], TARGETS)
    rows, shares, balance = mixed(corpus, targets, total=1_500_000.0)
    for r in rows[:200]:
        b = balance[r.source]
        assert abs(r.rate - min(b.cap, math.exp(b.lam / b.scale * r.n_tokens))) < 1e-5
    assert abs(shares["big"] - 0.5) < 0.002


def test_same_each_time_and_with_more_partitions(spark, corpus):
    targets = spark.createDataFrame([("big", 0.5, 2), ("mid", 0.5, 2)], TARGETS)
    one = sorted((r.doc_id or 0, r.copies) for r in mixed(corpus, targets)[0])
    assert one == sorted((r.doc_id or 0, r.copies) for r in mixed(corpus.repartition(7), targets)[0])


def test_edges(spark, corpus):
    none = spark.createDataFrame([], TARGETS)
    assert mixed(corpus, none)[0] == [] if False else M.mix(corpus, none)[0].collect() == []
    some = spark.createDataFrame([("big", 1.0, 1)], TARGETS)
    assert M.mix(docs(spark, []), some)[0].collect() == []
    assert M.share_report(M.mix(docs(spark, []), some)[0], some).first().actual_share == 0
    with pytest.raises(ValueError):
        M.mix(corpus, some, total=1e12)
    one, _ = M.mix(docs(spark, [(1, "big", 5, None, None)] * 3), some)
    assert [r.copies for r in one.collect()] == [1, 1, 1]
