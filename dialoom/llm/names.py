"""Typed names linked to the cast of a work, by merging and rematching.

Every member of the cast starts as a profile of its canonical name and listed aliases. Typed spellings meet
the profiles that share a block with them and are scored against them. The surest fits merge first: the
profile then holds that spelling, its words and its initials too, re-enters blocking with its keys, and is
scored again with the spellings still open. Every round takes the narrowest tolerance at which something merges; the
rounds end when nothing does.

Titles, their abbreviations, pet-name endings and the readings of Chinese characters are learnt from the
aliases of all casts. Spellings of nobody in the cast are merged with each other in `group_others`.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations, count

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.session import cut_lineage

from .lookalike import comparable, plain_points

# What follows a Chinese or Japanese name in address.
SUFFIXES = ("前辈", "小姐", "先生", "老师", "姐姐", "哥哥", "姐", "哥", "先輩", "ちゃん", "さん", "くん", "君", "様", "さま", "殿")
# Words that make a name somebody else's.
RELATIONS = ("的", "家の", "の")
_LINKING = frozenset("of the de del la el los las".split())
#: How badly a spelling may fit to be merged, one tolerance after the other: the same name in another form, a part or an
#: abbreviation of it; one error; all that the rules of the scripts let pass.
TOLERANCES = (0.75, 1.25, float("inf"))
#: A spelling that fits a second profile nearly as well is not merged.
MARGIN = 0.35
#: A cast is a dictionary that people keep; more names than this are taken for an error.
MAX_NAMES = 1_000_000

_INF = float("inf")
_TRIM = " \t　:：,，.。;；-–—*\"'|>〉»、"
_INITIALS = re.compile(r"(?:\w\.\s*)+\w")
_HAN = re.compile(r"[㐀-鿿]")
_KANA = re.compile(r"[ぁ-ヺ]")
_SYLLABLE = re.compile(r"(?:zh|ch|sh|[bpmfdtnlgkhjqxrzcsyw])?(?:iang|iong|uang|ang|eng|ong|ing|ian|iao|uan|uai|ai|ei|ao|ou|an|en|er|ia|ie|iu|in|ua|uo|ui|un|ue|a|o|e|i|u|v)")


@lru_cache(maxsize=100_000)
def bare(text: str) -> str:
    """Look-alikes, case, accents of Latin letters and outer marks removed."""
    plain = comparable(plain_points(text)) if not text.isascii() else text
    plain = plain.casefold()
    if not plain.isascii() and not _KANA.search(plain):
        plain = "".join(c for c in unicodedata.normalize("NFD", plain) if not "̀" <= c <= "ͯ")
    return " ".join(plain.strip(_TRIM).split())


def edits(a: str, b: str, limit: int) -> float:
    """Changed, lost, added and swapped neighbouring characters between a and b; infinite beyond the limit."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return _INF
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            cost = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, older[j - 2] + 1)
            row.append(cost)
        if min(row) > limit:
            return _INF
    return row[-1] if row[-1] <= limit else _INF


def _word_cost(typed: str, meant: str) -> float:
    return edits(typed, meant, 2 if len(meant) >= 5 else 1 if len(meant) >= 3 else 0)


def abbreviates(typed: str, meant: str) -> bool:
    """dr, prof, capt, soc: the first letter and others of the word, in their order."""
    if not 2 <= len(typed) < len(meant) or typed[0] != meant[0]:
        return False
    rest = iter(meant)
    return all(c in rest for c in typed)


@dataclass
class Lore:
    """What the aliases of all casts teach: titles, pet-name endings in kana, and how Chinese characters are read."""

    titles: frozenset[str] = frozenset()
    pets: tuple[str, ...] = ()
    readings: dict[str, str] = field(default_factory=dict)


def _without_title(words: list[str], lore: Lore) -> tuple[list[str], bool]:
    if len(words) > 1:
        first = words[0].strip(".")
        if first in lore.titles or len(first) <= 4 and any(abbreviates(first, t) for t in lore.titles) or len(first) >= 4 and any(
                edits(first, t, 1) <= 1 for t in lore.titles if len(t) >= 4):
            return words[1:], True
    return words, False


@dataclass
class Member:
    """One canonical name, taken apart for comparison."""

    canonical: str
    aliases: list[str]
    lore: Lore = field(default_factory=Lore)
    kind: str = ""
    words: list[str] = field(default_factory=list)
    alias_forms: list[list[str]] = field(default_factory=list)
    latin: list[list[str]] = field(default_factory=list)

    def __post_init__(self) -> None:
        name = bare(self.canonical)
        self.kind = "kana" if _KANA.search(name) else "han" if _HAN.search(name) else "latin"
        self.words = [w for w in re.split(r"[\s・·=＝]+", name) if w]
        self.alias_forms = [_without_title(bare(a).split(), self.lore)[0] for a in self.aliases if a and bare(a)]
        self.latin = [bare(a).split() for a in self.aliases if a and a.isascii() and len(a.split()) == 2]


def learn_readings(casts: list[tuple[str, list[str]]]) -> dict[str, str]:
    """Character -> Latin syllable, from Chinese names whose aliases give them in Latin letters (given name, surname)."""
    known: dict[str, str] = {}
    pairs: list[tuple[str, str]] = []
    for canonical, aliases in casts:
        if len(canonical) == 3 and all(_HAN.match(c) for c in canonical):
            for alias in aliases:
                parts = bare(alias).split() if alias and alias.isascii() else []
                if len(parts) == 2:
                    known.setdefault(canonical[0], parts[1])
                    pairs.append((canonical[1:], parts[0]))
    for _ in range(4):
        for chars, text in pairs:
            splits = [(text[:k], text[k:]) for k in range(1, len(text)) if _SYLLABLE.fullmatch(text[:k]) and _SYLLABLE.fullmatch(text[k:])]
            splits = [s for s in splits if all(known.get(c, p) == p for c, p in zip(chars, s))]
            if len(splits) == 1:
                known.update(dict(zip(chars, splits[0])))
    return known


def learn(casts: list[tuple[str, list[str]]]) -> Lore:
    """casts: (canonical name, aliases). A title is the first word of an alias that goes on with words of the name; an ending of pet
    names follows the first characters of a given name in kana, in two aliases or more."""
    titles, endings = set(), Counter()
    for canonical, aliases in casts:
        name = bare(canonical).split()
        given = re.split(r"[\s・·=＝]+", bare(canonical))[0]
        for alias in aliases:
            words = bare(alias or "").split()
            if len(words) > 1 and words[0] not in name and set(words[1:]) <= set(name) and _latin(words[0]):
                titles.add(words[0])
            if _KANA.search(given) and len(words) == 1:
                for k in (1, 2):
                    if len(words[0]) > k and _folded_kana(words[0][:k]) == _folded_kana(given[:k]) and not given.startswith(words[0][: k + 1]):
                        endings[words[0][k:]] += 1
    return Lore(frozenset(titles), tuple(sorted(e for e, n in endings.items() if n > 1 and len(e) > 1)), learn_readings(casts))


def _latin(word: str) -> bool:
    return word.isalpha() and not _HAN.search(word) and not _KANA.search(word)


class Cast:
    """The cast of one work; `match` links a typed spelling to it, and `costs` says how badly it fits a member's profile."""

    def __init__(self, names: dict[str, list[str]], lore: Lore | None = None):
        self.lore = lore or Lore()
        self.readings = self.lore.readings
        self.members = {k: Member(k, [a for a in v or [] if a], self.lore) for k, v in names.items() if k}
        self.exact: dict[str, set[str]] = {}
        for m in self.members.values():
            for form in {bare(m.canonical), *(bare(a) for a in m.aliases)}:
                if form:
                    self.exact.setdefault(form, set()).add(m.canonical)

    def match(self, spelling: str | None) -> tuple[str, float] | None:
        """(canonical name, cost) of the only member that the spelling fits best; None if there is none or several."""
        form = form_of(spelling)
        return _only({k: self.cost(form, k) for k in self.members}) if form else None

    def cost(self, form: str, canonical: str) -> float:
        """How badly a form fits the name and the listed aliases of a member; infinite if it does not."""
        if self.exact.get(form) == {canonical}:
            return -1.0  # nobody else goes by it
        member = self.members[canonical]
        cost = self._cost(form, member)
        if member.kind == "latin" and _INITIALS.fullmatch(form) and re.sub(r"\W", "", form) == "".join(w[0] for w in member.words):
            cost = min(cost, 0.6)
        return cost

    def cost_by(self, form: str, canonical: str, merged: str) -> float:
        """How badly a form fits the profile of a member that holds the form `merged`, too; infinite if it does not.

        The merged form stands for itself, and its words for the words of the name. One error in six characters or more
        is allowed, in fewer none.
        """
        cost = rematch_cost(form, merged, self.lore)
        for variant in self._variants(canonical, merged):
            most = 1.0 if min(len(form), len(variant.canonical)) >= 6 else 0.7
            found = self._cost(form, variant) + 0.05
            cost = min(cost, found) if found <= most else cost
        return cost

    @lru_cache(maxsize=20_000)  # noqa: B019 (a task has a few casts, which live as long as it does)
    def _variants(self, canonical: str, merged: str) -> list[Member]:
        """The name with a word of the merged form in place of its own."""
        member, typed = self.members[canonical], _words(merged, self.lore)
        if member.kind == "han" or len(member.words) != 2 or not 1 <= len(typed) <= 2:
            return []
        given, surname = member.words
        if len(typed) == 2 and (_word_cost(typed[0], surname) < _INF or _word_cost(typed[1], given) < _INF):
            typed = typed[::-1]
        pairs = [(typed[0], surname), (given, typed[-1])] if len(typed) == 2 else [(typed[0], surname)]
        mark = "・" if member.kind == "kana" else " "
        return [Member(mark.join(p), member.aliases, self.lore) for p in pairs if p != (given, surname) and all(len(w) >= 3 for w in p)]

    def _cost(self, name: str, m: Member) -> float:
        if m.kind == "kana":
            return _kana_cost(name, m)
        if m.kind == "han":
            return self._han_cost(name, m)
        words = [w for w in re.split(r"[\s,，\-/.·]+(?<!\.)|(?<=\w{2})\.\s*|\.\s+|,", name.replace("-", " ").replace(",", " ")) if w]
        rest, titled = _without_title(words, self.lore)
        words, rest = [w.strip(".") or w for w in words], [w.strip(".") or w for w in rest]
        if len(m.words) != 2:
            return _group_cost(words, name, m)
        return min(_person_cost(rest, m), _person_cost(words, m)) if titled else _person_cost(words, m)

    def _han_cost(self, name: str, m: Member) -> float:
        target = "".join(m.words)
        if name.isascii():
            forms = [list(x) for x in m.latin]
            if len(target) == 3 and all(c in self.readings for c in target):
                forms.append(["".join(self.readings[c] for c in target[1:]), self.readings[target[0]]])
            typed = re.split(r"[\s,\-]+", name)
            best = _INF
            if len(target) == 3 and sum(c in self.readings for c in target) == 2:  # one character is read in any way
                sur, *giv = [re.escape(self.readings[c]) if c in self.readings else _SYLLABLE.pattern for c in target]
                if re.fullmatch(f"(?:{sur} {giv[0]}{giv[1]}|{giv[0]}{giv[1]} {sur})", " ".join(typed)):
                    best = 0.5
            for given, surname in forms:
                for order in ([given, surname], [surname, given]):
                    if len(typed) == 2:
                        parts = [edits(a, b, 1) for a, b in zip(typed, order)]
                        best = min(best, sum(parts)) if sum(parts) <= 1 else best
                    elif len(typed) == 1:
                        best = min(best, 0.1 + edits(typed[0], "".join(order), 1))
                if len(typed) == 1:
                    best = min(best, 0.3 + edits(typed[0], given, 0))
            return best
        typed = re.sub(r"[\s·・\-]+", "", name)
        if any(r in typed for r in RELATIONS if r not in target):
            return _INF
        surname, given = target[0], target[1:]
        if typed in (target, given + surname):
            return 0.0
        for suffix in SUFFIXES:
            if typed.endswith(suffix) and len(typed) > len(suffix) + 1:
                return self._han_cost(typed[: -len(suffix)], m) + 0.1
        if typed == given:
            return 0.1
        if len(typed) == 2 and typed[0] in "小阿老" and given.endswith(typed[1]):
            return 0.3
        if len(target) >= 3:
            if sorted(typed) == sorted(target):
                return 0.5
            if len(typed) in (len(target), len(target) + 1) and edits(typed, target, 1) <= 1:
                return 0.9 if typed[-1] == target[-1] or typed[:2] == target[:2] else 1.0
            if typed[0] == surname and len(typed) == len(target) - 1 and edits(typed, target, 1) <= 1:
                return 1.3
            if set(typed) == set(given) and len(typed) <= len(given) + 1:
                return 0.6
            if len(typed) == len(given) == 2 and typed[0] not in "小阿老" and sum(a == b for a, b in zip(typed, given)) == 1:
                return 1.2
        return _INF


def _only(fits: dict[str, float]) -> tuple[str, float] | None:
    """(name, cost) of the one that fits clearly best."""
    costs = sorted((c, k) for k, c in fits.items() if c < _INF)
    if not costs or len(costs) > 1 and costs[1][0] - costs[0][0] < MARGIN:
        return None
    return costs[0][1], costs[0][0]


def _person_cost(t: list[str], m: Member) -> float:
    given, surname = m.words
    best = _INF
    if len(t) == 2:
        a, b = t
        best = min(_word_cost(a, given) + _word_cost(b, surname), _word_cost(a, surname) + _word_cost(b, given) + 0.1)
        if len(a) == 1 and a == given[0]:
            best = min(best, 0.6 + edits(b, surname, 1))
        if len(b) == 1 and b == surname[0]:
            best = min(best, 0.5 + edits(a, given, 1))
        if len(a) >= 3 and given.startswith(a) and a != given:
            best = min(best, 0.5 + edits(b, surname, 1))
        if len(a) == 1 and a == surname[0]:
            best = min(best, 0.7 + edits(b, given, 1))
        for form in m.alias_forms:
            if len(form) == 1 and len(form[0]) >= 3:
                best = min(best, 0.4 + edits(a, form[0], 1 if len(form[0]) >= 5 else 0) + edits(b, surname, 1))
    elif len(t) == 1:
        word = t[0]
        best = min(edits(word, given + surname, 2), edits(word, surname + given, 2) + 0.1)
        best = min(best, edits(word, given, 1 if len(given) < 7 else 2) + 0.2)
        for form in m.alias_forms:
            whole = "".join(form)
            best = min(best, edits(word, whole, 0 if len(whole) < 4 else 1) + 0.1)
    for form in m.alias_forms:
        if len(form) == len(t) > 1:
            best = min(best, sum(_word_cost(a, b) for a, b in zip(t, form)) + 0.1)
    return best


def _group_cost(t: list[str], name: str, m: Member) -> float:
    """Names of one word, and of groups: three words or more."""
    meant = m.words
    letters = re.sub(r"[^\w]", "", name)
    best = edits(letters, "".join(meant), 2 if len("".join(meant)) >= 8 else 1)
    for form in m.alias_forms:
        best = min(best, edits(letters, "".join(form), 1 if len("".join(form)) >= 5 else 0) + 0.1)
    if len(meant) < 3:
        return best
    core = [w for w in meant if w not in _LINKING]
    if letters in ("".join(w[0] for w in meant), "".join(w[0] for w in core)) and len(letters) >= 2:
        return min(best, 0.4)
    typed = [w for w in t if w not in _LINKING]
    if len(typed) < 2 or len(typed) > len(core):
        return best
    left, cost = list(core), 0.0
    for word in typed:
        found = min(((0.0 if w == word else 0.2 if abbreviates(word, w) else _word_cost(word, w)), k) for k, w in enumerate(left))
        if found[0] == _INF:
            return best
        cost += found[0]
        left.pop(found[1])
    return min(best, cost + 0.4 * len(left) + 0.1) if len(left) <= 1 else best


def _kana_cost(name: str, m: Member) -> float:
    if any(r in name for r in RELATIONS):
        return _INF
    given, surname = (m.words + [""])[:2]
    parts = [p for p in re.split(r"[\s・·=＝\-]+", name) if p]
    typed = "".join(parts)
    if typed in (given + surname, surname + given):
        return 0.0 if typed == given + surname else 0.1
    for suffix in SUFFIXES:
        if typed.endswith(suffix) and len(typed) > len(suffix) + 1:
            return _kana_cost(name[: name.rindex(suffix[0])], m) + 0.1
    for ending in m.lore.pets:
        if typed.endswith(ending) and len(typed) > len(ending):
            short = typed[: -len(ending)]
            if _folded_kana(given).startswith(_folded_kana(short)):
                return 0.4 if len(short) == 1 else 0.3
            if len(short) > 2:
                return _kana_cost(short, m) + 0.1
    if typed == given:
        return 0.2
    for form in m.alias_forms:
        if typed == "".join(form):
            return 0.1
    # long marks and small tsu come and go
    worn = re.sub("[ーッっ]", "", typed)
    if worn in (re.sub("[ーッっ]", "", given + surname), re.sub("[ーッっ]", "", surname + given)):
        return 0.4
    if worn == re.sub("[ーッっ]", "", given):
        return 0.5
    if len(parts) == 2 and len(surname) > 1:
        a, b = parts
        if edits(a, given, 1) <= 1 and surname.startswith(b):
            return 0.5 + edits(a, given, 1)
    best = min(edits(typed, given + surname, 2), edits(typed, surname + given, 2) + 0.1)
    if len(given) >= 3:
        best = min(best, edits(typed, given, 1) + 0.3)
    return best


def _folded_kana(text: str) -> str:
    """Small kana as large ones and voiced ones as plain ones."""
    plain = "".join(c for c in unicodedata.normalize("NFD", text) if c not in "゙゚")
    return plain.translate(str.maketrans("ァィゥェォャュョッぁぃぅぇぉゃゅょっ", "アイウエオヤユヨツあいうえおやゆよつ"))


def load_casts(configs: DataFrame) -> dict[str, dict[str, list[str]]]:
    """work_id -> canonical name -> aliases."""
    rows = configs.filter("work_id is not null and speaker_aliases is not null").select("work_id", "speaker_aliases").limit(MAX_NAMES + 1).collect()
    casts = {r.work_id: {k: list(v or []) for k, v in r.speaker_aliases.items()} for r in rows}
    if sum(len(c) for c in casts.values()) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} names in the casts")
    return casts


def form_of(spelling: str | None) -> str:
    """The form of a spelling by which it is compared; '' for none, and for signs in brackets, which are no names."""
    return "" if not spelling or spelling.lstrip()[:1] in "[【" else bare(spelling)


def _words(form: str, lore: Lore) -> list[str]:
    """The words of a form without title and marks."""
    return [x for w in _without_title(form.split(), lore)[0] for x in re.split(r"[\W_・]+", w) if x]


def block_keys(form: str, lore: Lore) -> list[str]:
    """The keys by which a form meets those it may be a variant of: beginnings and ends of the whole and of each word, single
    characters of short Chinese and Japanese names, and the initials in any order."""
    words = _words(form, lore)
    letters = "".join(words)
    keys = set()
    for part in {letters, *words}:
        plain = _folded_kana(re.sub("[ーッっ]", "", part)) if _KANA.search(part) else part
        if plain:
            keys |= {f"<{plain[:2]}", f">{plain[-2:]}", f"<{plain[0]}" if len(plain) <= 6 else f"<{plain[:2]}", f">{plain[-1]}" if len(plain) <= 6 else f">{plain[-2:]}"}
    if letters and _HAN.search(letters) and len(letters) <= 8:
        keys |= {f"+{c}" for c in letters if _HAN.match(c)}
    if len(words) > 1:
        keys |= {"=" + "".join(sorted(w[0] for w in words)), "=" + "".join(sorted(w[0] for w in words if w not in _LINKING))}
    if len(letters) <= 6:
        keys.add("=" + "".join(sorted(letters)))  # it may be initials itself
    return sorted(keys)


def word_keys(words: Iterable[str]) -> list[str]:
    """Keys that a word shares with every word one error from it: its beginning or its end; pairs of characters of Chinese words."""
    keys = set()
    for word in words:
        if _HAN.search(word):
            keys |= {"".join(sorted(p)) for p in combinations(word, 2)} if len(word) <= 8 else {word[:2], word[-2:]}
        sizes = {2 if len(word) < 6 else 3, 2 if len(word) == 6 else 3 if len(word) == 5 else 2 if len(word) < 6 else 3}
        keys |= {f"<{word[:k]}" for k in sizes} | {f">{word[-k:]}" for k in sizes}
    return sorted(keys)


def profile_keys(member: Member) -> list[str]:
    """The keys of a name and its aliases; of Chinese names also those of their readings."""
    lore = member.lore
    keys = {k for name in (member.canonical, *member.aliases) for k in block_keys(bare(name), lore)}
    if member.kind == "han":
        target = "".join(member.words)
        read = [lore.readings.get(c, "") for c in target]
        if len(read) == 3:
            whole = ["".join(read[1:]), read[0]] if all(read) else [r for r in read if r]
            keys |= set(block_keys(" ".join(w for w in whole if w), lore)) if any(whole) else set()
            keys |= {f"<{read[1][:2]}"} if read[1] else set()
    for word in member.words:
        if member.kind == "kana" and word:
            keys.add(f"<{_folded_kana(word)[0]}")
    return sorted(keys)


@lru_cache(maxsize=100_000)
def _profiled(form: str, titles: frozenset[str]) -> Member:
    """A merged form, taken apart as a canonical name is."""
    return Member(" ".join(_words(form, Lore(titles))), [])


def rematch_cost(form: str, merged: str, lore: Lore | None = None) -> float:
    """How badly a form fits one that is merged into a profile, by the rules of the script; infinite if it does not.

    A part of a merged form is no evidence, as the order of its parts is not known; one error is, in six characters or more.
    """
    lore = lore or Lore()
    words, m = _words(form, lore), _profiled(merged, lore.titles)
    typed, meant = "".join(words), "".join(m.words)
    if not typed or not meant or re.search(r"\d", typed + meant):
        return _INF
    if typed == meant:
        return 0.0
    if m.kind == "latin" and _INITIALS.fullmatch(form) and typed == "".join(w[0] for w in m.words):
        return 0.6
    most = 1.0 if min(len(typed), len(meant)) >= 6 else 0.7
    if m.kind == "han":
        cost = Cast({})._han_cost(form, m) if len(typed) > 1 and len(meant) > 1 and not form.isascii() else _INF
        return cost if cost <= 1.0 else _INF
    if len(words) == len(m.words):
        cost = _kana_cost(form, m) if m.kind == "kana" else _person_cost(words, m) if len(words) == 2 else _INF
        if min(len(typed), len(meant)) >= 6:
            cost = min(cost, edits(" ".join(words), " ".join(m.words), 1))
    else:
        cost = _INF
    if m.kind == "latin" and len(m.words) > 2:
        cost = min(cost, _group_cost(words, form, m))
    return cost if cost <= most else _INF


_FORM = "work_id string, speaker string, form string, keys array<string>, tight array<string>"
_FIT = "work_id string, form string, canonical string, cost double"


def _tasks(df: DataFrame) -> int:
    """Tasks for what is small in bytes but costly to compute, and would be packed into one."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _forms(spellings: DataFrame, lore: Lore, works: frozenset[str] | None) -> DataFrame:
    """Spellings with their form and keys; of the given works only."""
    shared = spellings.sparkSession.sparkContext.broadcast((lore, works))  # at most MAX_NAMES names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, named = shared.value
        for batch in batches:
            out = []
            for work, speaker in zip(batch["work_id"], batch["speaker"]):
                form = form_of(speaker) if named is None or work in named else ""
                if form:
                    out.append((work, speaker, form, block_keys(form, known), word_keys(_words(form, known))))
            yield pd.DataFrame(out, columns=["work_id", "speaker", "form", "keys", "tight"])

    return spellings.filter("speaker is not null and trim(speaker) <> ''").repartition(_tasks(spellings)).mapInPandas(run, _FORM)


def link_spellings(spellings: DataFrame, configs: DataFrame) -> DataFrame:
    """(work_id, speaker, canonical, round): the typed spellings that name a member of the work's cast, and the round that merged them.

    spellings: distinct (work_id, speaker). Null and blank spellings, signs in brackets, and spellings that fit no profile
    or several equally well, give no row. The canonical name itself is linked to itself.
    """
    casts = load_casts(configs)
    lore = learn([(k, v) for c in casts.values() for k, v in c.items()])
    spark = spellings.sparkSession
    shared = spark.sparkContext.broadcast((casts, lore))  # at most MAX_NAMES names
    typed = cut_lineage(_forms(spellings, lore, frozenset(casts)))
    forms = cut_lineage(typed.dropDuplicates(["work_id", "form"]).drop("speaker"))

    def score(pairs: DataFrame) -> DataFrame:
        """(work_id, form, canonical, cost) of pairs (work_id, form, canonical, merged); merged is null for the profile as it was listed."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            named, known = shared.value
            made: dict[str, Cast] = {}
            for batch in batches:
                out = []
                for work, form, canonical, merged in zip(batch["work_id"], batch["form"], batch["canonical"], batch["merged"]):
                    if work not in made:
                        made[work] = Cast(named[work], known)
                    cost = made[work].cost(form, canonical) if merged is None else made[work].cost_by(form, canonical, merged)
                    if cost < _INF:
                        out.append((work, form, canonical, cost))
                yield pd.DataFrame(out, columns=["work_id", "form", "canonical", "cost"])

        # one shuffle serves the distinct pairs, too
        return pairs.repartition(_tasks(pairs), "work_id", "form").distinct().mapInPandas(run, _FIT)

    def blocked(some: DataFrame, profiles: DataFrame, keys: str) -> DataFrame:
        return some.select("work_id", "form", F.explode(keys).alias("key")).join(
            profiles.select("work_id", "canonical", "merged", F.explode(keys).alias("key")), ["work_id", "key"]).drop("key")

    def lent(merged: DataFrame) -> DataFrame:
        """(work_id, canonical, merged, words, tight): the merged forms that bring words into a profile which its names do not have."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            named, known = shared.value
            for batch in batches:
                out = []
                for work, canonical, form in zip(batch["work_id"], batch["canonical"], batch["form"]):
                    own = {w for name in (canonical, *named[work][canonical]) if name for w in _words(bare(name), known)}
                    new = [w for w in _words(form, known) if w not in own and len(w) > 1]
                    if new:
                        out.append((work, canonical, form, " ".join(sorted(new)), word_keys(new)))
                yield pd.DataFrame(out, columns=["work_id", "canonical", "merged", "words", "tight"])

        rows = merged.select("work_id", "canonical", "form").mapInPandas(run, "work_id string, canonical string, merged string, words string, tight array<string>")
        return rows.dropDuplicates(["work_id", "canonical", "words"])

    listed = [(w, k, None, profile_keys(m)) for w, cast in casts.items() for k, m in Cast(cast, lore).members.items()]
    profiles = spark.createDataFrame(listed, "work_id string, canonical string, merged string, keys array<string>")
    key, profile = ["work_id", "form"], ["work_id", "canonical", "words"]
    linked = spark.createDataFrame([], "work_id string, form string, canonical string, round int")
    held = spark.createDataFrame([], "work_id string, canonical string, words string")
    fits = cut_lineage(score(blocked(forms, profiles, "keys")))
    for number in count(1):
        costs = F.array_sort(F.collect_list(F.struct("cost", "canonical")))  # one for each member in the block at most
        best = fits.groupBy(*key).agg(costs.alias("c")).filter((F.size("c") == 1) | (F.col("c")[1]["cost"] - F.col("c")[0]["cost"] >= MARGIN))
        clear = cut_lineage(best.select(*key, F.col("c")[0]["canonical"].alias("canonical"), F.col("c")[0]["cost"].alias("cost")))
        surest = clear.agg(F.min("cost")).first()[0]
        if surest is None:
            break
        merged = clear.filter(F.col("cost") <= next(t for t in TOLERANCES if surest <= t))
        linked = linked.unionByName(merged.select(*key, "canonical", F.lit(number).alias("round")))
        # the richer profiles re-enter blocking with what is still open
        richer = cut_lineage(lent(merged).join(held, profile, "left_anti"))
        held = held.unionByName(richer.select(*profile))
        still_open = forms.join(linked.select(*key), key, "left_anti")
        again = fits.join(merged.select(*key), key, "left_anti").unionByName(score(blocked(still_open, richer, "tight")))
        fits = cut_lineage(again.groupBy(*key, "canonical").agg(F.min("cost").alias("cost")))
    return typed.join(linked, key).select("work_id", "speaker", "canonical", "round")


def one_error_apart(a: str, b: str) -> bool:
    """One character changed, lost, added or swapped with its neighbour."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    start = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[start:], b[start:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    return max(len(a), len(b)) <= 1 or len(a) == len(b) == 2 and a == b[::-1]


_MODULUS, _BASE = (1 << 61) - 1, 911_382_323


def error_keys(form: str) -> list[tuple[str, bool]]:
    """(key, is_whole): two forms one error apart share a key. Forms that share one by a changed or swapped character are one
    error apart from each other; forms that lost a character to share one are so from the form that is this key as a whole."""
    n = len(form)
    before, after, power = [0], [0], [1]
    for c in form:
        before.append((before[-1] * _BASE + ord(c) + 1) % _MODULUS)
        power.append(power[-1] * _BASE % _MODULUS)
    for k, c in enumerate(reversed(form)):
        after.append((after[-1] + (ord(c) + 1) * power[k]) % _MODULUS)
    keys = {(f"w{n}:{before[n]}", True)}
    for k in range(n):
        left, right = before[k], after[n - k - 1]
        without = (left * power[n - k - 1] + right) % _MODULUS
        keys |= {(f"w{n - 1}:{without}", False), (f"s{n}:{k}:{without}", False)}
        if k + 1 < n and form[k] != form[k + 1]:
            low, high = sorted(form[k : k + 2])
            swapped = (before[k] * power[n - k - 2] + after[n - k - 2]) % _MODULUS
            keys.add((f"t{n}:{k}:{low}{high}:{swapped}", False))
    return sorted(keys)


def group_others(spellings: DataFrame, linked: DataFrame) -> DataFrame:
    """(work_id, speaker, entity): the spellings that name nobody in the cast, merged with each other.

    spellings: (work_id, speaker, n), with the number of uses; linked: (work_id, speaker) of the cast. Spellings of one work are
    one entity if their words are the same in any order, or if one error in six characters or more parts them, in as many
    steps as it takes. The entity is named by its most frequent spelling. No pairs within a block are made: forms that
    share a key are linked to its least one.
    """
    others = spellings.join(linked.select("work_id", "speaker"), ["work_id", "speaker"], "left_anti")
    typed = cut_lineage(_forms(others.select("work_id", "speaker").distinct(), Lore(), None).select(
        "work_id", "speaker", F.array_join(F.array_sort(F.split("form", r"[\s,]+")), " ").alias("form")))
    forms = typed.select("work_id", "form").distinct()

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(work, form, key, whole) for work, form in zip(batch["work_id"], batch["form"]) if len(form) >= 6 and not re.search(r"\d", form) for key, whole in error_keys(form)]
            yield pd.DataFrame(out, columns=["work_id", "form", "key", "whole"])

    keys = forms.repartition(_tasks(forms)).mapInPandas(keyed, "work_id string, form string, key string, whole boolean")
    # a key has as many forms as one place has characters, or a form has characters to lose
    met = keys.groupBy("work_id", "key").agg(F.collect_set("form").alias("forms"), F.min(F.when(F.col("whole"), F.col("form"))).alias("own"))
    leader = F.when(F.startswith("key", F.lit("w")), F.col("own")).otherwise(F.array_min("forms"))
    links = met.filter(F.size("forms") > 1).select("work_id", leader.alias("a"), F.explode("forms").alias("b")).filter("a <> b").distinct()
    apart = F.pandas_udf(lambda a, b: pd.Series([one_error_apart(x, y) for x, y in zip(a, b)], dtype=bool), "boolean")
    edges = cut_lineage(links.filter(apart("a", "b")))
    both = cut_lineage(edges.unionByName(edges.select("work_id", F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = cut_lineage(forms.withColumn("label", F.col("form")))
    while True:  # every round hands the least form on to the next neighbours, and to the neighbours of its label
        near = both.join(labels.withColumnRenamed("form", "a"), ["work_id", "a"]).groupBy("work_id", F.col("b").alias("form")).agg(F.min("label").alias("near"))
        least = labels.join(near, ["work_id", "form"], "left").select("work_id", "form", "label", F.least("label", "near").alias("next"))
        jump = least.select("work_id", F.col("form").alias("next"), F.col("next").alias("beyond"))
        stepped = cut_lineage(least.join(jump, ["work_id", "next"], "left").select("work_id", "form", "label", F.least("next", "beyond").alias("next")))
        labels = stepped.select("work_id", "form", F.col("next").alias("label"))
        if stepped.filter("label <> next").isEmpty():
            break
    entities = typed.join(labels, ["work_id", "form"]).join(spellings, ["work_id", "speaker"])
    named = entities.groupBy("work_id", "label").agg(F.max_by("speaker", F.struct("n", "speaker")).alias("entity"))
    return entities.join(named, ["work_id", "label"]).select("work_id", "speaker", "entity")


#: Spellings up to which their table is broadcast to the events.
BROADCAST_ROWS = 200_000


def link_events(events: DataFrame, runs: DataFrame, configs: DataFrame) -> DataFrame:
    """(video_id, event_id, speaker, canonical, round): every event whose speaker names a member of its work's cast in another
    spelling than the canonical one.

    events: (video_id, event_id, speaker); runs: (video_id, work_id). Redelivered rows give one row.
    Null speakers, videos without a work and works without a cast give none; an empty table gives none.
    Other columns are not read.
    """
    by_video = cut_lineage(typed_speakers(events, runs))
    linked = link_spellings(by_video.select("work_id", "speaker").distinct(), configs)
    table = cut_lineage(by_video.join(linked, ["work_id", "speaker"]).filter("speaker <> canonical").select("video_id", "speaker", "canonical", "round"))
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        table = F.broadcast(table)  # else the join shuffles, and adaptive execution splits what is skewed
    return events.select("video_id", "event_id", "speaker").join(table, ["video_id", "speaker"]).select(
        "video_id", "event_id", "speaker", "canonical", "round").distinct()


def typed_speakers(events: DataFrame, runs: DataFrame) -> DataFrame:
    """(video_id, work_id, speaker, n): the speakers of each video of a work, counted before they are shuffled."""
    work = runs.filter("work_id is not null").select("video_id", "work_id").dropDuplicates(["video_id"])
    return events.filter("speaker is not null").groupBy("video_id", "speaker").agg(F.count("*").alias("n")).join(work, "video_id")
