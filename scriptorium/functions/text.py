"""Column builders for recognised text: white space, case, repetition, quality flags and scores, line types."""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F



def let(value: Column, body) -> Column:
    """``body`` of a value that is made once for a row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# Marks, flags, penalties and patterns that results are defined by.
UNREADABLE = "[НЕРАЗБОРЧИВО]"
PENALTIES: Mapping[str, float] = {
    "empty_output": 100.0,
    "repetition_loop": 80.0,
    "repetition_truncated": 24.0,
    "suspicious_latin_output": 18.0,
    "very_long_line": 8.0,
}
SUSPICIOUS_FLAGS = ("empty_output", "repetition_truncated", "repetition_loop", "suspicious_latin_output", "very_long_line")
PAGE_NUMBER = r"\A[-–— ]*(?U:\d){1,4}[-–— ]*\z"
DATE = r"(?U)\b(?:[0-3]?\d[./-][01]?\d[./-](?:\d{2}|\d{4})|[0-3]?\d\s+[а-яё]+\s+\d{4})\b"
LIST_ITEM = r"(?U)\A\s*(?:[-•·]|\d+[.)]|[а-яё][.)])\s+"
SPACE = r"[\s\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: All white space but the blank, and few other characters. A class of many ranges, as SPACE is, costs ten times one that is
#: a list of characters below 256, or one or two ranges; most texts have none of these.
ODD_SPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\u0085\u00a0]"
FAR_SPACE = r"[\u1680-\u200f\u2028-\u3000]"
LATIN = f"[{string.ascii_letters}]"
CYRILLIC = "[А-Яа-яЁё]"
#: Letters whose full case folding is longer than, or other than, their lower case.
FOLDS = {"ß": "ss", "ς": "σ", "ſ": "s", "ŉ": "ʼn", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "µ": "μ"}


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    ends = lambda x: F.concat(F.left(x, F.lit(1)), F.right(x, F.lit(1)))
    return let(c, lambda x: F.when(ends(x).rlike(SPACE), F.regexp_replace(x, rf"{SPACE}+\z|\A{SPACE}+", "")).otherwise(x))


def odd_space(c: Column) -> Column:
    """False only where a text has no white space but blanks."""
    return c.rlike(ODD_SPACE) | ((F.octet_length(c) > F.length(c)) & c.rlike(FAR_SPACE))


def without_space(c: Column) -> Column:
    """Without any white space."""
    return let(c, lambda x: F.when(odd_space(x), F.regexp_replace(x, f"{SPACE}+", "")).otherwise(F.replace(x, F.lit(" "), F.lit(""))))


def normalize_space(c: Column) -> Column:
    """Runs of white space become one space; none is left at the ends; null becomes the empty text."""

    def single(x: Column) -> Column:
        return F.when(odd_space(x), F.regexp_replace(x, f"{SPACE}+", " ")).when(x.contains("  "), F.regexp_replace(x, " {2,}", " ")).otherwise(x)

    return F.trim(let(F.coalesce(c, F.lit("")), single))


def casefold(c: Column) -> Column:
    def folded(low: Column) -> Column:
        out = low
        for letter, other in FOLDS.items():
            out = F.replace(out, F.lit(letter), F.lit(other))
        return F.when(low.rlike(f"[{''.join(FOLDS)}]"), out).otherwise(low)  # few texts have such letters

    return let(F.lower(c), folded)


def normalized_literal(c: Column) -> Column:
    """What literal comparisons are made on: white space normalised, case folded."""
    return casefold(normalize_space(c))


def html_escape(c: Column) -> Column:
    """Escapes & < > of the stripped text (null: empty) and turns newlines into line breaks."""
    return escape(strip(F.coalesce(c, F.lit(""))))


def escape(out: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\n", "<br/>")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def letters_count(c: Column, pattern: str) -> Column:
    """How many characters of a text are of a class: what its runs take from the length, as runs are fewer than letters."""
    return let(c, lambda x: F.length(x) - F.length(F.regexp_replace(x, f"{pattern}+", "")))


def some_cyrillic(c: Column) -> Column:
    """False only where a text has no Cyrillic letter that counts."""
    return (F.octet_length(c) > F.length(c)) & c.rlike("[Ё-ё]")


def cyrillic_count(c: Column) -> Column:
    return let(c, lambda x: F.when(some_cyrillic(x), letters_count(x, CYRILLIC)).otherwise(F.length(x) * 0))


def latin_count(c: Column) -> Column:
    return letters_count(c, LATIN)


def digit_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"(?U)\d"))  # few, as a rule


def uppercase_ratio(c: Column) -> Column:
    """Upper-case share of Latin and Cyrillic letters, 0 without letters."""
    letters = letters_count(c, "[А-Яа-яЁёA-Za-z]")
    return F.when(letters > 0, letters_count(c, "[А-ЯЁA-Z]") / letters).otherwise(F.lit(0.0))


def characters(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("(?s)(.)"), F.lit(1))


def repeated_pattern(c: Column, normal: bool = False) -> Column:
    """Whether a text (``normal``: whose white space is normalised already) of 24 or more characters (white space apart) is a loop: one character twelve times in a row, or
    0.88 of it as if its first one to eleven characters went on and on."""

    def loops(letters: Column) -> Column:
        n = F.size(letters)

        def alike(p: Column) -> Column:
            same = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(letters, i) == F.get(letters, (i % p).cast("int")))
            return F.size(same) / n >= F.lit(0.88)

        return F.exists(F.sequence(F.lit(1), F.least(F.lit(11), F.floor(n / 6).cast("int"))), alike)

    # What is like a run of its first eleven characters consists of them, so most texts need no closer look; in most, the
    # first third holds enough others.
    other = lambda x, part: F.length(F.call_function("translate", part, F.substring(x, 1, 11), F.lit("")))
    return let(
        F.replace(c, F.lit(" "), F.lit("")) if normal else without_space(F.coalesce(c, F.lit(""))),
        lambda x: F.when(F.length(x) < 24, F.lit(False))
        .when(x.rlike(r"(?s)(.)\1{11,}"), F.lit(True))
        .when(other(x, F.left(x, F.floor(F.length(x) / 3).cast("int"))) > F.length(x) * F.lit(0.1200001), F.lit(False))
        .when(other(x, x) > F.length(x) * F.lit(0.1200001), F.lit(False))
        .otherwise(let(characters(x), loops)),
    )


def _kept_tokens(tokens: Column, least: int, longest: int) -> Column:
    n = F.size(tokens)

    def cut(p: Column) -> Column:
        differs = F.filter(F.sequence(F.lit(1), n - p), lambda j: F.get(tokens, j - 1) != F.get(tokens, j + p - 1))
        runs = let(
            F.floor((n - F.coalesce(F.array_max(differs), F.lit(0))) / p).cast("int"),
            lambda runs: F.when(runs >= least, F.struct((n - p * runs + 1).alias("start"), p.alias("p"))),
        )
        return F.when(F.get(tokens, n - 1) == F.get(tokens, n - p - 1), runs)

    periods = F.when(n >= least, F.sequence(F.lit(1), F.least(F.lit(longest), F.floor(n / least).cast("int")))).otherwise(F.array().cast("array<int>"))
    return let(F.array_min(F.array_compact(F.transform(periods, cut))), lambda best: best["start"] + best["p"] - 1)


def truncate_repetition(c: Column, least: int = 4, longest: int = 12) -> Column:
    """Struct (text, truncated) of a text with single spaces. Where its end repeats a run of up to ``longest`` tokens
    at least ``least`` times, the earliest start counts, then the shortest run, and one run of it is kept."""

    def result(tokens: Column) -> Column:
        return let(
            _kept_tokens(tokens, least, longest),
            lambda keep: F.struct(F.when(keep.isNull(), c).otherwise(F.array_join(F.slice(tokens, 1, keep), " ")).alias("text"), keep.isNotNull().alias("truncated")),
        )

    # What is repeated ends in the last token, so that stands before the end as well; few texts are split for it.
    last = F.substring_index(c, " ", -1)
    again = c.contains(F.concat(F.lit(" "), last, F.lit(" "))) | c.startswith(F.concat(last, F.lit(" ")))
    return F.when(again, let(F.split(c, " "), result)).when(c.isNotNull(), F.struct(c.alias("text"), F.lit(False).alias("truncated"))).otherwise(let(F.split(c, " "), result))


def mostly_latin(c: Column) -> Column:
    """Whether a text has five Latin letters or more, and more than half again as many as Cyrillic ones: letters of either
    kind are counted only where there may be both."""
    more = F.when(some_cyrillic(c), latin_count(c) > cyrillic_count(c) * 1.5).otherwise(F.lit(True))
    five = f"(?:{LATIN}[^{string.ascii_letters}]*+){{5}}"
    return (F.left(c, F.lit(64)).rlike(five) | c.rlike(five)) & more


def headline_stripped(c: Column, normal: bool = False) -> Column:
    return let(c if normal else normalize_space(c), lambda x: F.when(x.startswith("#"), F.regexp_replace(x, r"\A#{1,6} +", "")).otherwise(x))


def inspected(text: Column, cut: Column, truncated: Column, loop: Column) -> Column:
    """Struct (text, flags) from the parts of the inspection; see ``operators.quality.inspect``."""
    flags = F.array_compact(
        F.array(
            F.when(truncated, F.lit("repetition_truncated")),
            F.when(loop, F.lit("repetition_loop")),
            F.when(~loop & mostly_latin(cut), F.lit("suspicious_latin_output")),
            F.when(~loop & (F.length(cut) >= 240), F.lit("very_long_line")),
        )
    )
    return F.when(text == "", F.struct(F.lit(UNREADABLE).alias("text"), F.array(F.lit("empty_output")).alias("flags"))).otherwise(
        F.struct(F.when(loop, F.lit(UNREADABLE)).otherwise(cut).alias("text"), flags.alias("flags"))
    )


def quality_score(text: Column, flags: Column, normal: bool = False) -> Column:
    """The worth of a recognised line (``normal``: whose white space is normalised already); -100 where it is empty or
    unreadable."""
    cost = F.create_map(*(F.lit(x) for pair in PENALTIES.items() for x in pair))
    lost = F.aggregate(F.coalesce(flags, F.array().cast("array<string>")), F.lit(0.0), lambda a, f: a + F.coalesce(F.try_element_at(cost, f), F.lit(0.0)))

    def worth(t: Column, cyrillic: Column) -> Column:
        most = F.length(t) * F.lit(0.08) >= F.lit(40.0)  # by its length alone
        out = F.when(most, F.lit(40.0)).otherwise(F.least(F.lit(40.0), (cyrillic + digit_count(t)) * F.lit(0.7) + F.length(t) * F.lit(0.08)))
        return out + F.when(cyrillic > 0, 8.0).otherwise(0.0) - F.when(mostly_latin(t), 18.0).otherwise(0.0)

    def of(t: Column) -> Column:
        return F.when((t == "") | (t == UNREADABLE), F.lit(-100.0)).otherwise(let(cyrillic_count(t), lambda n: worth(t, n)) - lost)

    return let(text if normal else normalize_space(text), of)


def line_type(text: Column, x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """The type of a line by its text and its place on the page."""
    t = strip(F.coalesce(text, F.lit("")))
    cx = (x1 + x2) / 2
    low = F.lower(t)
    edge = ((y1 < height * F.lit(0.14)) | (y2 > height * F.lit(0.86))) & ((cx < width * F.lit(0.25)) | (cx > width * F.lit(0.75)))
    centred = F.abs(cx - width / 2) <= width * F.lit(0.16)
    short = F.length(t) <= 100
    return (
        F.when(t == "", "unknown")
        .when(t.rlike(PAGE_NUMBER) & edge, "page_number")
        .when(low.rlike(DATE) & (F.length(t) <= 80), "date")
        .when(low.rlike(LIST_ITEM), "list_item")
        .when(short & centred & (uppercase_ratio(t) >= F.lit(0.65)), "title")
        .when(short & centred & (y1 < height * F.lit(0.35)), "subtitle")
        .otherwise("text")
    )


def basename(c: Column) -> Column:
    """The last part of a path with either kind of slash; empty for null."""
    return F.element_at(F.split(F.replace(strip(F.coalesce(c, F.lit(""))), F.lit("\\"), F.lit("/")), "/"), -1)


def positive_int(c: Column, fallback: Column) -> Column:
    n = F.regexp_extract(F.coalesce(c.cast("string"), F.lit("")), rf"\A{SPACE}*([+-]?\d{{1,9}}){SPACE}*\z", 1).try_cast("int")
    return F.when(n > 0, n).otherwise(fallback)


def stem_and_suffix(name: Column) -> tuple[Column, Column]:
    """A file name before and from its last dot; a dot at either end does not count."""
    cut = name.rlike(r"(?s)\A.+\.[^.]+\z") & ~name.rlike(r"\A\.+[^.]*\z")
    return F.when(cut, F.regexp_extract(name, r"(?s)\A(.+)\.[^.]+\z", 1)).otherwise(name), F.when(cut, F.lower(F.regexp_extract(name, r"(\.[^.]+)\z", 1))).otherwise("")
