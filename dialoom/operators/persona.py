"""How speakers speak: repeated phrases, particles, forms of address; and small rule tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Modal particles.
PARTICLES = ("嗯", "呐", "呢", "吗", "哦", "啊", "嘛", "呀", "吧", "ね", "よ", "わ")
#: Kind of information -> where it is filed.
ROUTES = (
    ("world", "story"), ("ability", "story"), ("plot", "story"), ("relationship", "story"), ("knowledge", "story"),
    ("style", "persona"), ("expression", "persona"), ("emotion", "persona"), ("behaviour", "persona"), ("personality", "persona"),
    ("both", "story"), ("both", "persona"))

#: A cast is a dictionary that people keep; more names than this are taken for an error.
MAX_NAMES = 1_000_000

#: Characters of scripts without blanks: Chinese and Japanese, without the middle dot.
UNSPACED = r"\x{3005}-\x{3007}\x{3041}-\x{309f}\x{30a1}-\x{30fa}\x{30fc}-\x{30ff}\x{31f0}-\x{31ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{ff66}-\x{ff9f}\x{20000}-\x{3ffff}"


def tokens(text: Column) -> Column:
    """The words of a text; in scripts without blanks each character is one."""
    return F.regexp_extract_all(text, F.lit(rf"([{UNSPACED}]|[\p{{L}}\p{{N}}'&&[^{UNSPACED}]]+)"), F.lit(1))


def phrases(events: DataFrame, size: int = 3, at_least: int = 3) -> DataFrame:
    """(speaker, phrase, n): sequences of `size` words that a speaker says at least `at_least` times, in lower case. In scripts without
    blanks every character is a word, and a phrase holds no blanks between them. Null speakers and texts say nothing."""
    words = tokens(F.lower("text"))
    starts = F.sequence(F.lit(1), F.size(words) - size + 1)
    grams = F.when(F.size(words) >= size, F.transform(starts, lambda k: F.array_join(F.slice(words, k, size), " ")))
    said = events.filter("speaker is not null").select("speaker", F.explode(grams).alias("phrase"))
    joined = said.withColumn("phrase", F.regexp_replace("phrase", f"(?<=[{UNSPACED}]) (?=[{UNSPACED}])", ""))
    return joined.groupBy("speaker", "phrase").agg(F.count("*").alias("n")).filter(F.col("n") >= at_least)


def token_counts(events: DataFrame, tokens=PARTICLES) -> DataFrame:
    """(speaker, token, n): how often each token stands in the texts of a speaker."""
    found = F.explode(F.regexp_extract_all("text", F.lit("(" + "|".join(tokens) + ")"), F.lit(1)))
    return events.filter("speaker is not null").select("speaker", found.alias("token")).groupBy("speaker", "token").agg(F.count("*").alias("n"))


def mentions(events: DataFrame, names: DataFrame) -> DataFrame:
    """(speaker, name, n): whom a speaker mentions, by names of any length and script. names: (work_id, name); events need work_id.

    Texts and names are cut alike by `tokens`, so that marks and repeated blanks do not count and a name is never found inside a word
    of a spaced script. Every occurrence counts, also one that overlaps another name's.
    """
    cast = names.select("work_id", "name").distinct().withColumn("tokens", tokens(F.col("name"))).filter("work_id is not null and size(tokens) > 0").limit(MAX_NAMES + 1).collect()
    if len(cast) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} names in the casts")
    tries: dict[str, dict] = {}
    for work, name, parts in cast:
        node = tries.setdefault(work, {})
        for part in parts:
            node = node.setdefault(part, {})
        node.setdefault(None, []).append(name)  # several names may be cut alike
    shared = events.sparkSession.sparkContext.broadcast(tries)  # at most MAX_NAMES names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter = Counter()
            for work, speaker, parts in zip(batch["work_id"], batch["speaker"], batch["tokens"]):
                root = shared.value.get(work, {})
                for start in range(len(parts)):
                    node = root
                    for at in range(start, len(parts)):
                        node = node.get(parts[at])
                        if node is None:
                            break
                        found.update((speaker, name) for name in node.get(None, ()))
            yield pd.DataFrame([(*key, n) for key, n in found.items()], columns=["speaker", "name", "n"])

    said = events.filter("speaker is not null and text is not null").select("work_id", "speaker", tokens(F.col("text")).alias("tokens"))
    return said.mapInPandas(run, "speaker string, name string, n bigint").groupBy("speaker", "name").agg(F.sum("n").alias("n"))


def apply_rules(tags: DataFrame, rules: DataFrame, on: str = "tag") -> DataFrame:
    """Each tag with its rule; null where there is none."""
    return tags.join(rules, on, "left")


def route(items: DataFrame, kind: str = "kind") -> DataFrame:
    """items with target: one row per place where the item is filed; kinds without a route are dropped."""
    table = items.sparkSession.createDataFrame(list(ROUTES), f"{kind} string, target string")
    return items.join(F.broadcast(table), kind)  # a fixed table


def classify_facts(old: DataFrame, new: DataFrame, key: list[str], value: str = "value") -> DataFrame:
    """(key, status): `new` where only the new side has it, `kept` where only the old has it, `fixed` where the old value was null,
    `same` or `extended` where the new text begins with the old one, else `conflict`."""
    a, b = old.select(*key, F.col(value).alias("_old"), F.lit(True).alias("_a")), new.select(*key, F.col(value).alias("_new"), F.lit(True).alias("_b"))
    status = (F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "kept").when(F.col("_old").isNull() & F.col("_new").isNotNull(), "fixed")
              .when(F.col("_old").eqNullSafe(F.col("_new")), "same").when(F.startswith("_new", "_old"), "extended").otherwise("conflict"))
    return a.join(b, key, "full_outer").select(*key, status.alias("status"))
