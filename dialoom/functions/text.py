"""Column expressions for dialogue text: stripping, quality, review routing, rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the characters that count as white space, as a regular-expression class for Java and RE2.
WHITE = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Punctuation and its ASCII form, one character for one; an ellipsis becomes three dots besides.
WIDE_PUNCTUATION, ASCII_PUNCTUATION = "（）。，！？：；～—　", "().,!?:;~- "
#: What counts as content, and what a text of punctuation only consists of.
CONTENT = r"[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}a-zA-Z0-9]"
PUNCTUATION_ONLY = r"^(?:" + WHITE + r"|[（）。，、！？…\"「」()\.,!?;:'\-—~·])+$"
#: How a short text has to end to be complete.
COMPLETE_END = "[。！？）)～~…」』】]$"
#: Phrases by which a reviewer objects.
OBJECTIONS = ("不对", "不是这样的", "她不会这样说", "她不会这么做", "她应该是", "她其实会", "这不像她", "感觉不太像", "她遇到这种情况会", "她的性格不是这样", "这个语气不对", "她不会用这个称呼")


def strip(text: Column) -> Column:
    """The text without white space of any kind at its ends."""
    return F.regexp_replace(text, f"^{WHITE}+|{WHITE}+$", "")


def ascii_punctuation(text: Column) -> Column:
    return F.replace(F.translate(text, WIDE_PUNCTUATION, ASCII_PUNCTUATION), F.lit("…"), F.lit("..."))


def content_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(CONTENT))


def _count(text: Column, char: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(char), F.lit("")))


def _balanced(text: Column, opening: str, closing: str) -> Column:
    return _count(text, opening) == _count(text, closing)


def passes_quality(text: Column) -> Column:
    """Not punctuation only, two content characters or more, and balanced wide brackets and quotes."""
    return ~text.rlike(PUNCTUATION_ONLY) & (content_count(text) >= 2) & _balanced(text, "（", "）") & _balanced(text, "「", "」")


def effective_confidence(event: Column, speaker: Column, speaker_confidence: Column) -> Column:
    """The lower of the two confidences; the event's where there is no speaker."""
    return F.when(F.coalesce(speaker, F.lit("")) != "", F.least(event, speaker_confidence)).otherwise(event)


def needs_review(text: Column, speaker: Column, confidence: Column, threshold) -> Column:
    """Low confidence, no speaker, or too little content in a text that is no complete short line."""
    complete = strip(text).rlike(COMPLETE_END) & _balanced(text, "（", "）") & _balanced(text, "(", ")") & (content_count(text) >= 1)
    return (confidence < threshold) | (F.coalesce(speaker, F.lit("")) == "") | ((content_count(text) < 2) & ~complete)


def is_hud(text: Column) -> Column:
    """Counters, levels and other display text: five patterns on the stripped text."""
    t = strip(text)
    digits_only = t.rlike(f"^(?:\\d|{WHITE}|/)+$")
    ratio = t.rlike(f"^\\d+{WHITE}*/{WHITE}*\\d+")
    code = t.rlike(r"^[A-Z0-9]{2,}$")
    label = t.rlike(f"^[A-Z]{{2,}}{WHITE}*\\d")
    short = (F.char_length(t) <= 3) & t.rlike(r"\d")
    return (t != "") & (digits_only | ratio | code | label | short)


def seconds_to_ms(seconds: Column) -> Column:
    """Truncated, not rounded."""
    return (seconds * 1000).cast("bigint")


def stamp(ms: Column) -> Column:
    """[HH:MM:SS]; hours go beyond 99."""
    seconds = F.floor(ms / 1000).cast("bigint")
    return F.format_string("[%02d:%02d:%02d]", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60)


def srt_stamp(ms: Column) -> Column:
    seconds = F.floor(ms / 1000).cast("bigint")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60, ms % 1000)


def transcript_line(start_ms: Column, speaker: Column, text: Column) -> Column:
    return F.when(F.coalesce(speaker, F.lit("")) != "", F.concat(stamp(start_ms), F.lit(" "), speaker, F.lit(": "), text)).otherwise(
        F.concat(stamp(start_ms), F.lit(" "), text))


def slug(name: Column) -> Column:
    """Latin letters and digits in lower case, joined by hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def objects(text: Column, phrases=OBJECTIONS) -> Column:
    """The text holds one of the phrases."""
    return text.rlike("|".join(phrases))


def escape_html(text: Column) -> Column:
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text
