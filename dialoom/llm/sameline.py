"""Do two texts say the same line, read or written a little differently?

Differences of spacing, punctuation, case, accents and look-alike characters never count. The rest is
aligned word by word, or character by character in Chinese and Japanese, and each difference is judged:
lost, doubled and visually confused characters are misreadings; other words, added words, numbers,
negations, sides and persons say something else.
"""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher
from functools import lru_cache

import regex

from .lookalike import comparable, plain_points

# Groups of words of which one in place of another changes what a line says; English, then Spanish.
MEANING_GROUPS = (
    "no not never none nothing nobody neither nor without every all some any each both either always yes",
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand first second third",
    "left right up down in out on off before after over under north south east west here there",
    "he she it they we you him her them us me", "his hers their our my mine", "this that these those", "now then", "more less most least", "open close",
    "can cannot can't", "do don't does doesn't did didn't", "will won't", "is isn't are aren't was wasn't were weren't",
    "nunca jamás nada nadie ningún ninguno ninguna sin sí no siempre todo toda todos todas algún alguno alguien algo cada ambos",
    "cero uno una dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince veinte treinta cien mil primero primera segundo segunda tercero tercera",
    "izquierda derecha arriba abajo dentro fuera antes después aquí allí", "él ella ello ellos ellas yo tú usted nosotros ustedes",
    "mi tu su mis tus sus", "este esta esto ese esa eso aquel aquella", "más menos")
# Characters that negate a Chinese or Japanese line, and those that change it in place of another.
NEGATING_CHARS = frozenset("不没未无無非勿别莫")
MEANING_CHARS = frozenset("不没未无無非否勿别莫一二两三四五六七八九十百千万零〇左右上下前后後東东西南北内外他她它你您我俺僕私彼女男大小多少早晚今昨明来去生死开開关閉")
# Groups of letters that are read for one another.
CONFUSED_LETTERS = ("hb", "uv", "ce", "il1tj", "0oq", "5s", "8b", "gq9", "nu", "vy", "ft", "z2", "6b", "aeo", "mn")
# Letter sequences that look like one letter, and that letter.
CONFUSED_SEQUENCES = (("rn", "m"), ("cl", "d"), ("vv", "w"), ("ii", "u"), ("0", "o"), ("1", "l"), ("5", "s"), ("|", "l"))
# Groups of Chinese characters and kana that are read for one another.
CONFUSED_CHARS = (
    "未末", "日曰目", "土士", "人入八", "己已巳", "大太犬", "天夫", "王玉主", "千干于", "木本", "刀力", "田由甲申", "鸟乌", "问间", "侯候",
    "ソンリ", "シツッ", "クワケ", "ロ口", "カ力", "タ夕", "エ工", "ニ二", "ハ八", "ー一", "ヘへ", "つっ", "やゃ", "ゆゅ", "よょ", "アァ", "イィ", "ウゥ", "エェ", "オォ",
    "ぬめ", "れわね", "るろ", "さき", "はほ", "いり", "こに", "はばぱ", "ひびぴ", "ふぶぷ", "へべぺ", "ほぼぽ", "かが", "きぎ", "くぐ", "けげ", "こご", "さざ", "しじ", "すず", "せぜ", "そぞ", "ただ", "ちぢ", "てで", "とど")
# English and Spanish words of one letter.
_ONE_LETTER_WORDS = frozenset("aieouy")
_UNREAD = frozenset("□�■")

_CJK = r"\p{Han}\p{Hiragana}\p{Katakana}ー"
_TOKEN = regex.compile(rf"[{_CJK}□�■]|(?:(?![{_CJK}])[\p{{L}}\p{{N}}\p{{M}}□�■])+(?:['’](?:(?![{_CJK}])[\p{{L}}])+)*")
_GROUPS: dict[str, set[int]] = {}
for _k, _words in enumerate(MEANING_GROUPS):
    for _word in _words.split():
        _GROUPS.setdefault(_word, set()).add(_k)
_LETTER_PAIRS = frozenset((a, b) for g in CONFUSED_LETTERS for a in g for b in g if a != b)
_CHAR_PAIRS = frozenset((a, b) for g in CONFUSED_CHARS for a in g for b in g if a != b)


def _bare(word: str) -> str:
    """The word without accents on Latin letters."""
    if word.isascii():
        return word
    return "".join(c for c in unicodedata.normalize("NFD", word) if not "̀" <= c <= "ͯ") if "぀" > max(word) else word


@lru_cache(maxsize=50_000)
def tokens(text: str) -> tuple[tuple[str, ...], bool]:
    """The words of a text in comparable form, single characters in Chinese and Japanese; whether most are such characters."""
    plain = plain_points(text)
    if not plain.isascii():
        plain = comparable(plain)
    found = tuple(w.replace("’", "'") for w in _TOKEN.findall(plain.casefold()))
    single = sum(len(w) == 1 and ord(w) >= 0x2E80 for w in found)
    return found, 2 * single > len(found)


@lru_cache(maxsize=50_000)
def _folded(word: str) -> str:
    word = _bare(word)
    if word.isdigit():
        return word
    for seen, meant in CONFUSED_SEQUENCES:
        word = word.replace(seen, meant)
    return word.replace("'", "")


def _misread_cost(a: str, b: str, limit: float) -> float:
    """The least cost of turning a into b by losing, doubling and confusing letters; infinite beyond `limit`.

    A letter that a lost next to one that b lost may be another letter, not two losses: that is allowed inside words of
    five letters or more only.
    """
    inf = float("inf")
    if abs(len(a) - len(b)) > limit:
        return inf
    long = max(len(a), len(b)) >= 5
    # per column: the least cost if the last letter was read, was lost from b, was lost from a
    read, dropped, added = [0.0] + [inf] * len(b), [inf] * (len(b) + 1), [0.0]
    for j, y in enumerate(b):
        added.append(added[-1] + (0.5 if j and b[j - 1] == y else 1.0))
    added[0] = inf
    for i, x in enumerate(a):
        drop = 0.5 if i and a[i - 1] == x else 1.0
        new_read, new_dropped, new_added = [inf], [min(read[0], dropped[0]) + drop], [inf]
        for j, y in enumerate(b):
            change = 0.0 if x == y else 0.8 if (x, y) in _LETTER_PAIRS or x in _UNREAD or y in _UNREAD else inf
            new_read.append(min(read[j], dropped[j], added[j]) + change)
            new_dropped.append(min(read[j + 1], dropped[j + 1]) + drop)
            new_added.append(min(new_read[j], new_added[j], new_dropped[j] if long and i and j else inf) + (0.5 if j and b[j - 1] == y else 1.0))
        if min(*new_read, *new_dropped, *new_added) > limit:
            return inf
        read, dropped, added = new_read, new_dropped, new_added
    least = min(read[-1], dropped[-1], added[-1])
    return least if least <= limit else inf


def _digits(words: tuple[str, ...]) -> list[str]:
    return [w for w in words if w.isdigit()]


def _words_agree(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """The cost of reading the words a as b; infinite if they say something else."""
    inf = float("inf")
    if not a or not b:
        return inf
    if len(a) == len(b):
        for x, y in zip(a, b):
            if x != y and _GROUPS.get(x, set()) & _GROUPS.get(y, set()):
                return inf
    x, y = "".join(a), "".join(b)
    if _bare(x) == _bare(y) and not _digits(a + b):
        return 0.0
    lettered = not x.isdigit() and not y.isdigit()
    if _folded(x) == _folded(y) and lettered:
        return 0.5
    if _digits(a) != _digits(b):
        return inf
    # letters that look like one are read as one, or stand for themselves
    return min(_spelling_cost(_folded(x), _folded(y)), _spelling_cost(_bare(x), _bare(y)))


def _spelling_cost(x: str, y: str) -> float:
    if min(len(x), len(y)) < 2:  # one letter for another, or of a word of two letters one was lost
        short, long = sorted((x, y), key=len)
        if len(long) == 3 and short and long[0] == short and short not in _ONE_LETTER_WORDS:
            return 1.8  # only the first letter was read
        lost = len(x) + len(y) == 3 and (x in y or y in x)
        return 1.0 if lost or (x, y) in _LETTER_PAIRS else float("inf")
    longest = max(len(x), len(y))
    return _misread_cost(x, y, max(1.8 if longest >= 3 else 1.0, 0.5 * longest))


def _chars_agree(a: tuple[str, ...], b: tuple[str, ...], before: str, after: str) -> float:
    inf = float("inf")
    x, y = "".join(a), "".join(b)
    if x and y:
        if any(c in _UNREAD for c in x + y) and max(len(x), len(y)) <= 2:
            return 0.8
        if len(x) == len(y):
            costs = [0.0 if p == q else 0.8 if (p, q) in _CHAR_PAIRS else inf for p, q in zip(x, y)]
            changed = any(p != q and p in MEANING_CHARS and q in MEANING_CHARS for p, q in zip(x, y))
            return inf if changed else sum(costs)
        short, long = sorted((x, y), key=len)
        rest = SequenceMatcher(None, short, long, autojunk=False).get_matching_blocks()
        if sum(m.size for m in rest) == len(short) and len(long) - len(short) == 1:
            return 1.0
        return inf
    extra = x or y
    if set(extra) <= {before, after}:
        return 0.5 * len(extra)
    return 1.0 if len(extra) == 1 and extra not in NEGATING_CHARS else inf


def same_line(a: str | None, b: str | None) -> bool:
    """True if the texts say the same line. Null equals null only; texts without words agree if they are equal up to repetition."""
    if a is None or b is None or a == b:
        return a == b
    (x, dense), (y, _) = tokens(a), tokens(b)
    if not x or not y:
        return not x and not y and a.strip()[:1] == b.strip()[:1]
    if x == y:
        return True
    size, other = sum(map(len, x)), sum(map(len, y))
    if size == other and "".join(x) == "".join(y) and not _digits(x + y):
        return True  # cut into words in another way
    if min(size, other) * 1.6 + 6 < max(size, other):
        return False
    if not set(x) & set(y) and len(x) > 2 and len(y) > 2:
        return False
    # a field limit cut both texts at one length: what one lost or gained before, the other has at its end
    equally_long = len(plain_points(a)) == len(plain_points(b))
    size = max(size, other)
    budget, cost = max(1.6, 0.2 * size), 0.0
    ops = SequenceMatcher(None, x, y, autojunk=False).get_opcodes()
    for kind, i, j, k, m in ops:
        if kind == "equal":
            continue
        if dense:
            cost += _chars_agree(x[i:j], y[k:m], x[i - 1] if i else "", x[j] if j < len(x) else "")
        elif kind == "replace":
            cost += _words_agree(x[i:j], y[k:m])
        elif equally_long and j == len(x) and m == len(y) and cost and len("".join(x[i:j] + y[k:m])) <= 3 * cost:
            cost += 1.0
        elif all(w in _UNREAD or len(w) == 1 and not w.isdigit() for w in x[i:j] + y[k:m]):
            cost += 1.0
        elif len(set(x[i - 1 : j + 1] + y[k - 1 : m + 1])) == 1 and i:
            cost += 1.0  # a word was doubled
        else:
            return False
        if cost > budget:
            return False
    return True
