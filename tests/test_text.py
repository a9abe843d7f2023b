"""Text rules on what the driver's tables do not hold: Cyrillic, odd white space, repetition of every kind."""

import random
import re

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import text as tx
from scriptorium.operators import quality


def values(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("text", "want"),
    [("  а б\u0085в\x1cг ", "а б в г"), (None, ""), ("", ""), ("Straße  ẞ ﬁ", "strasse ss fi"), ("ΑΣ", "ασ")],
)
def test_normalised(spark, text, want):
    assert values(spark, [text], tx.normalized_literal(F.col("text")))[0][0] == want


def model_cut(tokens):
    for start in range(len(tokens)):
        rest = len(tokens) - start
        for p in range(1, min(12, rest) + 1):
            if rest >= 4 * p and rest % p == 0 and all(tokens[i] == tokens[start + (i - start) % p] for i in range(start, len(tokens))):
                return tokens[: start + p], True
    return tokens, False


def test_repeated_tails(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(400):
        unit = rng.choices("абв", k=rng.randint(1, 4))
        texts.append(" ".join(rng.choices("абвг", k=rng.randint(0, 5)) + unit * rng.randint(0, 6)))
    texts = [t for t in texts if t]
    got = values(spark, texts, tx.truncate_repetition(F.col("text")).alias("c"))
    for t, (c,) in zip(texts, got, strict=True):
        kept, cut = model_cut(t.split(" "))
        assert (c["text"], c["truncated"]) == (" ".join(kept), cut)


def model_loop(text):
    s = re.sub(r"\s+", "", text)
    if len(s) < 24:
        return False
    if re.search(r"(.)\1{11,}", s):
        return True
    return any(sum(s[i] == s[i % p] for i in range(len(s))) / len(s) >= 0.88 for p in range(1, min(12, len(s) // 6 + 1)))


def test_loops(spark):
    rng = random.Random(4)
    texts = ["аб" * 12, "а" * 12 + "бвгдежзийклм", "а" * 11 + "бвгдежзийклмн", "short", ""]
    for _ in range(300):
        unit = "".join(rng.choices("абвгдежзик", k=rng.randint(1, 13)))
        s = list(unit * rng.randint(1, 9))
        for _ in range(rng.randint(0, 5)):
            s[rng.randrange(len(s))] = rng.choice("xyz")
        texts.append("".join(s))
    got = values(spark, texts, tx.repeated_pattern(F.col("text")))
    assert [g[0] for g in got] == [model_loop(t) for t in texts]


def test_flags_and_scores(spark):
    texts = ["", "## Заголовок", "да да да да да", "abcdef", "Ж" * 240, "абв" * 20]
    df = quality.inspect(spark.createDataFrame([(t,) for t in texts], "text string"))
    got = [(r["inspected"]["text"], r["inspected"]["flags"]) for r in df.collect()]
    assert got[0] == (tx.UNREADABLE, ["empty_output"])
    assert got[1] == ("Заголовок", [])
    assert got[2] == ("да", ["repetition_truncated"])
    assert got[3] == ("abcdef", ["suspicious_latin_output"])
    assert got[4] == (tx.UNREADABLE, ["repetition_loop"]) and got[5] == (tx.UNREADABLE, ["repetition_loop"])
    score = values(spark, ["Привет, мир 12", tx.UNREADABLE, "x" * 10], tx.quality_score(F.col("text"), F.array(F.lit("very_long_line"))))
    assert [round(s[0], 2) for s in score] == [round(min(40, 11 * 0.7 + 14 * 0.08) + 8 - 8, 2), -100.0, round(0.8 - 18 - 8, 2)]


@pytest.mark.parametrize(
    ("text", "box", "want"),
    [
        (" – 12 – ", (20, 20, 90, 50), "page_number"), ("12", (450, 600, 550, 640), "title_or_text"), ("от 3 марта 1911 г.", (10, 600, 900, 640), "date"), ("а) пункт", (10, 600, 900, 640), "list_item"),
        ("• пункт", (10, 600, 900, 640), "list_item"), ("ОТЧЁТ", (400, 600, 600, 640), "title"), ("Отчёт о работах", (400, 100, 600, 140), "subtitle"), ("Отчёт", (0, 600, 400, 640), "text"), (" ", (0, 0, 1, 1), "unknown"), (None, (0, 0, 1, 1), "unknown"),
    ],
)
def test_line_types(spark, text, box, want):
    got = values(spark, [text], tx.line_type(F.col("text"), *map(F.lit, box), F.lit(1000), F.lit(1300)))[0][0]
    assert got == want or (want == "title_or_text" and got in ("title", "text", "subtitle"))


def test_numbers_and_names(spark):
    got = values(spark, [" 5 ", "5.0", "-1", "x", None, "007"], tx.positive_int(F.col("text"), F.lit(9)))
    assert [g[0] for g in got] == [5, 9, 9, 9, 9, 7]
    assert [g[0] for g in values(spark, ["a\\b/c.pdf", "", None], tx.basename(F.col("text")))] == ["c.pdf", "", ""]
    assert values(spark, [" <a> & \n\"b\" "], tx.html_escape(F.col("text")))[0][0] == '&lt;a&gt; &amp; <br/>"b"'
