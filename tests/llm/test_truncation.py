import random

import pytest

from dialoom.llm import truncation as X

SUBJECTS = ["the captain", "my sister", "a stranger", "the old fisher", "our neighbour", "the clerk"]
VERBS = ["lost", "found", "painted", "carried", "mended", "sold"]
THINGS = ["a golden bell", "the quiet lamp", "an empty basket", "the red door", "a small kite", "the broken clock"]
PLACES = ["near the harbour", "at the station", "under the bridge", "behind the market"]


def sentence(rng):
    return f"{rng.choice(SUBJECTS).capitalize()} {rng.choice(VERBS)} {rng.choice(THINGS)} {rng.choice(PLACES)}"


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts of four sources with known cuts: limits of 60 characters, 70 bytes and 50 characters with a mark, and losses in transfer."""
    rng, rows, cut = random.Random(5), [], set()
    for k in range(4000):
        text = ". ".join(sentence(rng) for _ in range(rng.choice([1, 1, 2, 3]))) + "."
        source, event = rng.choice(["plain", "chars", "bytes", "marked"]), f"event_{k:06d}"
        whole = text
        if rng.random() < 0.05:
            text = text[:-1]  # a lost full stop is no cut
        elif rng.random() < 0.03:
            text = rng.choice(["Signal lost", "Episode two", "OK", "HP 12/99", "The Golden Hour", "Well…", "You cannot mean—"])
        elif rng.random() < 0.04 and source == "plain":
            at = rng.randrange(12, len(text) - 14)
            text = text[:at].rstrip() + rng.choice(["", "&am", "\\u00", "�"])
            cut.add(event)
        limit = {"chars": 60, "bytes": 70, "marked": 50}.get(source)
        if limit and len(text) > limit:
            text = text[: limit - (source == "marked")] + ("…" if source == "marked" else "")
            if not text.endswith("."):
                cut.add(event)
        assert whole
        rows.append(("v", event, f"{source}/v.mp4", text, rng.random() < 0.5))
    df = spark.createDataFrame(rows, "video_id string, event_id string, source_file string, text string, review_required boolean")
    return df, cut


def test_finds_the_cuts(corpus):
    df, cut = corpus
    got = {r.event_id for r in X.detect_cuts(df).collect()}
    assert len(got & cut) >= 0.97 * len(cut)
    assert len(got & cut) >= 0.97 * len(got)


def test_limits(corpus):
    df, _ = corpus
    once = df.select("video_id", "event_id", X.capture_source(df["source_file"]).alias("source"), "text")
    got = {r.source: (r.unit, r.n) for r in X.field_limits(once).collect()}
    assert got == {"chars": ("chars", 60), "bytes": ("chars", 70), "marked": ("chars", 50)}


def test_shares(corpus):
    df, _ = corpus
    got = {r.source: r for r in X.cut_shares(df).collect()}
    assert set(got) == {"plain", "chars", "bytes", "marked"}
    assert all(r.cut_share == round(r.n_cut / r.n_events, 6) and r.n_flagged <= r.n_cut for r in got.values())


@pytest.mark.parametrize("text, broken, unclosed", [
    ("He said “hello", False, "“"), ("The seal reads «Свет»", False, ""), ("a (b [c", False, "(["), ("fine.", False, ""), ("tail &quo", True, ""), ("tail \\u30", True, ""), ("tail �", True, ""), ("a <b", True, ""), ("¿Qué", False, "¿"), ("", False, "")])
def test_automaton(text, broken, unclosed):
    ending = X.read_ending(text)
    assert (ending.broken, ending.unclosed) == (broken, unclosed)


@pytest.mark.parametrize("text, terminated", [("It isn'", False), ("It isn’", False), ("‘It is.’", True), ("It is.'", True), ("(an aside)", True), ("Yes", False), ("Oh—", True)])
def test_apostrophes_are_no_end(text, terminated):
    assert X.read_ending(text).terminated == terminated


def test_context_hashes_do_not_depend_on_the_place():
    alone, _, last = X._hashes(["the end of it"])
    among, owner, ends = X._hashes(["another", "the end of it", "x"])
    assert (alone[:, last.argmax()] == among[:, [k for k in range(len(ends)) if ends[k] and owner[k] == 1][0]]).all()
    longer, _, last2 = X._hashes(["before the end of it"])
    row = X.CONTEXTS.index(9)
    assert alone[row, last.argmax()] == longer[row, last2.argmax()] and alone[0, last.argmax()] != longer[0, last2.argmax()]


def test_edges(make_events):
    rows = [("v", 1, 0, 1, "A", None), ("v", 2, 0, 1, "A", ""), ("v", 3, 0, 1, "A", "word " * 40_000 + "end."), ("v", 4, 0, 1, None, "lost &am"), ("v", 4, 0, 1, None, "lost &am")]
    assert [(r.event_id, r.why) for r in X.detect_cuts(make_events(rows)).collect()] == [("event_000004", "broken")]
    assert [r.event_id for r in X.detect_cuts(make_events(rows, source=None)).collect()] == ["event_000004"]
    assert X.detect_cuts(make_events([])).count() == 0 and X.cut_shares(make_events([])).count() == 0


@pytest.mark.parametrize("text", ["It rose by 50%", "We met at AT&T", "Love R&D", "C:\\", "I <3 you", "a < b and so on", 'a board of 6" width', "Tom & Jerry", "<br>Titles", "<p>One line", 'He said "no"', "{a} and (b)", "Q&A", "me&we"])
def test_everyday_signs_are_no_evidence(text):
    ending = X.read_ending(text)
    assert not ending.broken and not ending.unclosed


@pytest.mark.parametrize("text, unclosed", [('He said "I will go and', '"'), ("<b>bold text without a close", "<"), ("open {brace and", "{"), ("a (b [c) d", ""), ("<i>x</i> <div class='a'>y", "<"), ('"a" and "b', '"'), ("(a. Then (b) c.", "(")])
def test_signs_left_open(text, unclosed):
    assert X.read_ending(text).unclosed == unclosed and X._judge("s", text, X._Sources({}, {}, frozenset("s"))) == ("broken" if unclosed else "ask")


@pytest.mark.parametrize("text", ["and then&quo", "and then&am", "and &#12", "the name \\u00", "the \\x", "lost�", "see <a href=\"" + "x" * 5000, "so </di"])
def test_half_an_escape_is_evidence_anywhere(text):
    assert X.read_ending(text).broken


def test_what_may_be_half_an_escape_is_held_against_the_source(spark):
    rows = [("v", f"e{k}", "web/x", text) for k, text in enumerate(["a%20b%2Cc.", "d%20e.", "f%20", "It rose by 50%", "go to x%2"])]
    rows += [("v", f"f{k}", "deck/x", text) for k, text in enumerate(["It rose by 50%.", "It rose by 50%", "go to x%2"])]
    df = spark.createDataFrame(rows, "video_id string, event_id string, source_file string, text string")
    assert {r.event_id for r in X.detect_cuts(df).collect() if r.why == "broken"} == {"e3", "e4"}
    habits = {r.source: r.escapes for r in X.source_habits(df.select(X.capture_source(df["source_file"]).alias("source"), "text")).collect()}
    assert habits == {"web": ["percent"], "deck": []}


def test_an_open_sign_after_a_full_stop_counts_where_a_source_closes_what_it_opens(spark):
    rows = [("v", f"a{k:03d}", "tidy/x", f"Scene {k} (at night). It rains.") for k in range(40)] + [("v", "a999", "tidy/x", "Scene (at night. It rains.")]
    rows += [("v", f"b{k:03d}", "loose/x", f"(At night {k}. It rains.") for k in range(40)]
    df = spark.createDataFrame(rows, "video_id string, event_id string, source_file string, text string")
    assert {r.event_id for r in X.detect_cuts(df).collect()} == {"a999"}


def test_blocks_of_the_filter_do_not_matter(corpus, monkeypatch):
    df, _ = corpus
    whole = {tuple(r) for r in X.detect_cuts(df).collect()}
    monkeypatch.setattr(X, "BLOCK_CONTEXTS", 700)
    assert {tuple(r) for r in X.detect_cuts(df).collect()} == whole
