import numpy as np
import pytest

from dialoom.llm import turns as U

ALIASES, SPECIAL = {"Bramuck Sidel": ["Brai "], "Gikáck Sidel": ["Doctor Gikáck"], "沅音漪": ["小漪"]}, {"Narrator": "[narrator]", "???": "[unknown]"}
NAMES = U.roster(ALIASES, SPECIAL)


@pytest.mark.parametrize("label, name", [
    ("Bramuck Sidel", "Bramuck Sidel"), (">> bramuck", "Bramuck Sidel"), ("- BRAI", "Bramuck Sidel"), ("[Gikáck Sidel]", "Gikáck Sidel"), ("Gikáck (V.O.)", "Gikáck Sidel"), ("DOCTOR GIKÁCK (cont'd)", "Gikáck Sidel"), ("Bramuck —", "Bramuck Sidel"),
    ("【音漪】", "沅音漪"), ("小漪：", "沅音漪"), ("沅音漪（画外音）", "沅音漪"), ("Narrator", "[narrator]"), (">> [narrator]", "[narrator]"), ("???", "[unknown]"), ("[UNKNOWN] (V.O.)", "[unknown]"), ("Sidel", None), ("", None)])
def test_labels(label, name):
    assert NAMES.get(U.label_form(label)) == name


@pytest.mark.parametrize("text, time, speaker, clean", [
    ("[00:00:14] Listen. Hold it.", 14_000, None, "Listen. Hold it."), ("(0:27) (wind)", 27_000, None, ""), ("<00:00:25.1> My hands.", 25_100, None, "My hands."), ("00:00:07,404 --> 小漪：你好", 7_404, "沅音漪", "你好"),
    ("00:01:33 - Bramuck Sidel - Stay.", 93_000, "Bramuck Sidel", "Stay."), ("00:01:37 - >> Gikáck - ¿Eh? Sí.", 97_000, "Gikáck Sidel", "¿Eh? Sí."), (">> bramuck: (door slams) Let's go", None, "Bramuck Sidel", "Let's go"), ("???: Er, no.", None, "[unknown]", "No."),
    ("Er, um...", None, None, ""), ("嗯……", None, None, ""), ("啊，这个……", None, None, ""), ("あの…… ♪～", None, None, ""), ("♪♪ Thank, uh, you", None, None, "Thank you"), ("别碰那个镜子！", None, None, "别碰那个镜子！"), ("那个，别碰", None, None, "别碰"),
    (None, None, None, ""), ("", None, None, ""), ("Listen: go", None, None, "Listen: go"), ("[" + "sighs, " * 1500 + "] Come in.", None, None, "Come in."), ("Stay (" + "a long way off: " * 50 + ") here", None, None, "Stay here"),
    ("Brai (from very far away: " + "x" * 200 + "): No.", None, "Bramuck Sidel", "No."), ("One : two : three : Brai : no", None, None, "One : two : three : Brai : no"), ("word " * 20_000, None, None, "Word " + "word " * 19_998 + "word")])
def test_rows(text, time, speaker, clean):
    assert U.parse_row(text, NAMES) == (time, speaker, clean)


def test_least_cost_assignment_equals_all_permutations():
    from itertools import permutations

    rng = np.random.default_rng(1)
    for n, m in [(1, 1), (2, 3), (3, 3), (4, 5)]:
        cost = rng.random((n, m))
        got = U.least_cost_assignment(cost)
        assert len(set(got)) == n and abs(sum(cost[i, j] for i, j in enumerate(got)) - min(sum(cost[i, p[i]] for i in range(n)) for p in permutations(range(m), n))) < 1e-9
    assert sorted(U.least_cost_assignment(rng.random((3, 2)))) [0] == -1


def made(spark, make_events, rows, **options):
    runs = spark.createDataFrame([("v", "w"), ("w", "w"), ("bare", None)], "video_id string, work_id string")
    configs = spark.createDataFrame([("w", ALIASES, SPECIAL), ("z", None, None)], "work_id string, speaker_aliases map<string,array<string>>, special_speakers map<string,string>")
    got = U.speaker_turns(make_events(rows).drop("work_id"), runs, configs, **options).collect()
    return sorted((r.video_id, int(r.first_event_id[-6:]), int(r.last_event_id[-6:]), r.speaker, r.n_rows, r.text) for r in got)


def test_turns(spark, make_events):
    rows = [("v", 1, 0, 900, "Bramuck", "Hi."), ("v", 2, 1000, 1900, None, "Go on."), ("v", 3, 2000, 2900, "Gikáck", "[laughs]"), ("v", 4, 3000, 3900, " ", "Still me."), ("v", 5, None, None, None, "[00:00:04] ???: Who?"),
            ("v", 6, 5000, 5900, "narrator:", "So."), ("v", 7, 6000, 6900, "[narrator]", "It ends."), ("v", 7, 6000, 6900, "[narrator]", "It ends."), ("bare", 1, 0, 1, "X", "alone"), ("v", None, 1, 2, "X", "y"), ("w", 1, 0, 1, None, None)]
    expected = [("bare", 1, 1, "X", 1, "Alone"), ("v", 1, 4, "Bramuck Sidel", 3, "Hi. Go on. Still me."), ("v", 5, 5, "[unknown]", 1, "Who?"), ("v", 6, 7, "[narrator]", 2, "So. It ends.")]
    for parts in (1, 3, 9):
        assert made(spark, make_events, rows, parts=parts) == expected
    assert made(spark, make_events, []) == []


def test_labels_are_assigned_by_sound(spark, make_events):
    rows = [("v", 1, 0, 900, "Bramuk Sidel", "Hi."), ("v", 2, 1000, 1900, "Gikack Sidel", "Ho."), ("v", 3, 2000, 2900, "Someone Else:", "No."), ("v", 4, 3000, 3900, "Brammuck Sidel", "Yes."),
            ("w", 1, 0, 900, "Bramukc Sidel", "So."), ("bare", 1, 0, 900, "Bramuk Sidel", "Who?")]
    got = made(spark, make_events, rows)
    assert [(g[0], g[3]) for g in got] == [("bare", "Bramuk Sidel"), ("v", "Bramuck Sidel"), ("v", "Gikáck Sidel"), ("v", "Someone Else"), ("v", "Bramuck Sidel"), ("w", "Bramuck Sidel")]


def test_spellings_share_a_name_and_ties_spread():
    # two misspellings of one speaker both go to it; what fits two names equally goes to the one that is not taken
    assert U.assign_spellings({"jonathon": {"Jonathan": 1.0, "Johan": 2.0}, "jonatan": {"Jonathan": 1.0}}) == {"jonathon": "Jonathan", "jonatan": "Jonathan"}
    assert U.assign_spellings({"ana": {"Ane": 1.0}, "anx": {"Ane": 1.0, "Anx": 1.0}, "any": {"Ane": 1.0, "Anx": 1.0}}) == {"ana": "Ane", "anx": "Anx", "any": "Ane"}
    assert U.assign_spellings({}) == {}


def test_spellings_are_assigned_at_the_least_cost():
    from itertools import product

    rng = np.random.default_rng(2)
    for _ in range(50):
        cost = {f"s{i}": {f"n{j}": float(rng.integers(1, 3)) for j in range(3) if rng.random() < 0.8 or j == 0} for i in range(4)}
        got = U.assign_spellings(cost)

        def value(chosen):
            counts = {}
            for n in chosen.values():
                counts[n] = counts.get(n, 0) + 1
            return sum(cost[s][n] for s, n in chosen.items()), sum(c * c for c in counts.values())

        assert value(got) == min(value(dict(zip(cost, names))) for names in product(*cost.values()))


def test_rows_without_a_time_keep_their_place(spark, make_events):
    rows = [("v", 1, 0, 900, "Bramuck", "One."), ("v", 2, 3_600_000, 3_600_900, "Gikáck", "Two."), ("v", 3, None, None, None, "Three has no time."), ("v", 4, 7_200_000, 7_200_900, "Bramuck", "Four."),
            ("v", 5, None, None, None, "[02:00:05] Five."), ("v", 6, None, None, "Gikáck", "Six.")]
    for parts in (1, 2, 6):
        assert made(spark, make_events, rows, parts=parts) == [("v", 1, 1, "Bramuck Sidel", 1, "One."), ("v", 2, 3, "Gikáck Sidel", 2, "Two. Three has no time."),
                                                              ("v", 4, 5, "Bramuck Sidel", 2, "Four. Five."), ("v", 6, 6, "Gikáck Sidel", 1, "Six.")]


@pytest.mark.parametrize("parts", [2, 9, 40])
def test_parts_do_not_matter(spark, make_events, parts):
    import random

    rng = random.Random(3)
    rows = [(rng.choice("vw"), k, rng.choice([k * 500, None]), k * 500 + 400, rng.choice([None, None, "Bramuck", "Gikáck", "???", "Bramuk Sidel"]), rng.choice(["Yes I do.", "Um...", "(wind)", "Brai: no way"])) for k in range(150)]
    assert made(spark, make_events, rows, parts=parts) == made(spark, make_events, rows, parts=1)
