"""Mixing sources to target shares of the total size by entropy balancing.

Every document gets a rate, the expected number of its copies. The rates are the closest ones to "each
document once" (in relative entropy) whose tokens per source meet the source's target and that stay
under the source's cap: rate = min(cap, exp(lambda_source * n_tokens)). The lambdas solve the convex
dual by Newton iterations; each is one distributed aggregate over the histogram of document sizes,
which is an exact statistic of the corpus. The rates are then rounded into whole copies.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.session import cut_lineage

#: mix_targets is a small table that people write; more rows than this are taken for an error.
MAX_TARGETS = 100_000
#: First bracket of the solutions, in units of the mean size.
_LAMBDA = 60.0


@dataclass
class Balance:
    """What the dual solution says about one source. `scale` is the mean size, by which lambda is divided."""

    share: float
    cap: int
    docs: int
    tokens: int
    goal: float
    scale: float = 1.0
    lam: float = 0.0
    shift: float = 0.0


def read_targets(targets: DataFrame) -> dict[str, tuple[float, int]]:
    """source -> (target share, most copies), of the rows with a source and a positive share and cap."""
    rows = targets.select("source", "target_share", "max_repeats").limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} target rows")
    out: dict[str, tuple[float, int]] = {}
    for source, share, cap in rows:
        if source is not None and share and share > 0 and cap and cap > 0:
            old = out.get(source, (0.0, 0))
            out[source] = (old[0] + share, max(old[1], cap))
    return out


def solve(sizes: DataFrame, targets: dict[str, tuple[float, int]], total: float | None = None, steps: int = 60, tolerance: float = 1e-7) -> dict[str, Balance]:
    """The balance of every source that has a target and tokens.

    sizes: (source, n_tokens, n_docs), the histogram. total: tokens of the mixture; the largest that
    the caps allow where it is null. Targets of sources without tokens cannot be met: the other shares
    are scaled up to sum to 1. RuntimeError names the sources whose balance `steps` steps do not find.
    """
    wanted = sizes.sparkSession.createDataFrame([(s,) for s in sorted(targets)], "source string")
    have = {r.source: r for r in sizes.join(F.broadcast(wanted), "source").groupBy("source").agg(
        F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("tokens")).collect() if r.tokens}
    whole = sum(targets[s][0] for s in have)
    if not have:
        return {}
    most = min(targets[s][1] * r.tokens * whole / targets[s][0] for s, r in have.items())
    if total is None:
        total = most
    elif total > most * (1 + 1e-9):
        raise ValueError(f"the caps allow {most:.0f} tokens at these shares, not {total:.0f}")
    out = {s: Balance(targets[s][0], targets[s][1], r.docs, r.tokens, total * targets[s][0] / whole, r.tokens / r.docs) for s, r in have.items()}
    low = dict.fromkeys(out, -_LAMBDA)
    high = dict.fromkeys(out, _LAMBDA)
    open_ = set()
    for s, b in out.items():
        if b.goal >= b.cap * b.tokens * (1 - 1e-9):
            b.lam = math.inf
        else:
            open_.add(s)
    for _ in range(steps):
        if not open_:
            break
        now = sizes.sparkSession.createDataFrame([(s, out[s].lam / out[s].scale, float(out[s].cap)) for s in sorted(open_)], "source string, lam double, cap double")
        cap = F.col("cap")
        rate = F.least(cap, F.exp(F.least(F.col("lam") * F.col("n_tokens"), F.log(cap) + 1)))
        mass = rate * F.col("n_docs") * F.col("n_tokens")
        got = sizes.join(F.broadcast(now), "source").groupBy("source").agg(  # at most MAX_TARGETS rows
            F.sum(mass).alias("value"),
            F.sum(F.when(rate < cap, mass * F.col("n_tokens")).otherwise(0.0)).alias("slope")).collect()
        for s, value, slope in got:
            b = out[s]
            gap = b.goal - value
            if abs(gap) <= tolerance * b.goal or high[s] - low[s] < 1e-12 * max(1.0, abs(b.lam)):
                open_.discard(s)
                continue
            # the bracket grows until the solution is inside
            if gap > 0 and b.lam > high[s] / 2:
                high[s] *= 4
            elif gap < 0 and b.lam < low[s] / 2:
                low[s] *= 4
            low[s], high[s] = (b.lam, high[s]) if gap > 0 else (low[s], b.lam)
            newton = b.lam + gap * b.scale / slope if slope > 0 else math.nan
            # the dual has kinks at the cap: a step out of the bracket is replaced by halving it
            b.lam = newton if low[s] < newton < high[s] else (low[s] + high[s]) / 2
    if open_:
        raise RuntimeError(f"no balance after {steps} steps for the sources {sorted(open_)}")
    return out


def with_rates(docs: DataFrame, balance: dict[str, Balance], id_col: str, seed: int) -> DataFrame:
    """docs of the balanced sources with rate and the place `u` of each document in [0, 1)."""
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(s, b.lam / b.scale if math.isfinite(b.lam) else None, float(b.cap), b.shift) for s, b in balance.items()],
        "source string, lam double, cap double, shift double")
    joined = docs.join(F.broadcast(table), "source")  # at most MAX_TARGETS rows
    rate = F.when(F.col("lam").isNull(), F.col("cap")).otherwise(
        F.least("cap", F.exp(F.least(F.col("lam") * F.col("n_tokens"), F.log("cap") + 1))))
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 40)) / float(1 << 40)
    return joined.filter(F.col("n_tokens") > 0).withColumn("rate", rate).withColumn("u", place)


def round_rates(rated: DataFrame, balance: dict[str, Balance], buckets: int = 1024) -> None:
    """Sets the shift of every source: a document gets one more copy where u < fraction + shift.

    Without a shift the rounding is unbiased but off by chance; the shift meets the goal to about a
    share 1/buckets of the fractional tokens. One aggregate with at most 2 * buckets rows a source.
    """
    part = F.col("rate") - F.floor("rate")
    rows = rated.select(
        "source", (F.floor("rate") * F.col("n_tokens")).alias("sure"),
        F.when(part > 1e-9, F.floor((F.col("u") - part) * buckets)).alias("bucket"), "n_tokens",
    ).groupBy("source", "bucket").agg(F.sum("sure").alias("sure"), F.sum("n_tokens").alias("tokens")).collect()
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    for s, rs in by.items():
        missing = balance[s].goal - sum(r.sure for r in rs)
        best, best_gap, filled = -1.0, abs(missing), 0
        for r in sorted((r for r in rs if r.bucket is not None), key=lambda r: r.bucket):
            filled += r.tokens
            if abs(missing - filled) <= best_gap:
                best, best_gap = (r.bucket + 1) / buckets, abs(missing - filled)
        balance[s].shift = best


def mix(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", total: float | None = None, seed: int = 1) -> tuple[DataFrame, dict[str, Balance]]:
    """(id_col, source, n_tokens, rate, copies) of the documents that come into the mixture, and the balances.

    docs: (id_col, source, n_tokens), read several times, so a written or checkpointed table. Documents
    without tokens, without a source or of a source without a target do not come in. Repeated rows are
    documents of their own with the same id and so the same number of copies. Empty tables give no rows.
    """
    docs = docs.select(id_col, "source", "n_tokens")
    sizes = cut_lineage(docs.filter("n_tokens > 0 and source is not null").groupBy("source", "n_tokens").agg(F.count("*").alias("n_docs")))
    balance = solve(sizes, read_targets(targets), total)
    if not balance:
        return docs.limit(0).select(id_col, "source", "n_tokens", F.lit(0.0).alias("rate"), F.lit(0).alias("copies")), {}
    round_rates(with_rates(docs, balance, id_col, seed), balance)
    rated = with_rates(docs, balance, id_col, seed)
    part = F.col("rate") - F.floor("rate")
    copies = (F.floor("rate") + F.when((part > 1e-9) & (F.col("u") < part + F.col("shift")), 1).otherwise(0)).cast("int")
    out = rated.select(id_col, "source", "n_tokens", F.round("rate", 6).alias("rate"), copies.alias("copies"))
    return out.filter("copies > 0"), balance


def share_report(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source with a target: what was asked for and what the mixture reaches, 0 where it has no documents."""
    got = mixture.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum("copies").alias("n_copies"),
        F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"), F.max("copies").alias("most_copies"))
    whole = got.agg(F.sum("tokens").alias("all_tokens"))
    wanted = targets.filter("source is not null").groupBy("source").agg(
        F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_docs", "n_copies", "tokens", "most_copies")}
    return wanted.join(got, "source", "left").withColumns(zero).join(F.broadcast(whole)).select(
        "source", "target_share", "max_repeats", "n_docs", "n_copies", "tokens", "most_copies",
        F.round(F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)), 6).alias("actual_share"))
