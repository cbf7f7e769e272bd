"""Randomised strings against plain-Python versions of the same rules.

Thousands of generated texts go through Spark in one job per rule; each
result must equal the plain version in ``text_rules``.
"""

import random

import pytest
import text_rules as rules

from posting_analytics.functions import match, money, text

N = 3000


def texts(seed, alphabet, max_len):
    rnd = random.Random(seed)
    return [("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, max_len))),)
            for _ in range(N)]


def run(spark, rows, col):
    df = spark.createDataFrame(rows, "t string").coalesce(4)
    return [(r["t"], r["o"]) for r in df.select("t", col.alias("o")).collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_amount_range_random(spark, seed):
    alphabet = ["Rp", "rP", "RP", "p", " ", "  ", "\t", ".", ",", "0", "1", "5", "9", "00", "x", "\n"]
    for t, got in run(spark, texts(seed, alphabet, 30), money.amount_range("t")):
        assert got == rules.amount_range(rules.AmountScanner(t, mark="rp").amounts()), repr(t)


def test_money_format_random(spark):
    alphabet = ["0", "1", "7", "9", ".", ",", " ", "a", "Rp", "-"]
    for t, got in run(spark, texts(3, alphabet, 40), money.money_format("t")):
        assert got == rules.money(t), repr(t)


def test_normalize_ws_random(spark):
    alphabet = ["a", "b", " ", "\t", "\n", "\r", "\x0b", "\x0c", "\xa0", " ", "　", "\x1f", "é"]
    for t, got in run(spark, texts(4, alphabet, 25), text.normalize_ws("t")):
        assert got == rules.one_space(t), repr(t)


def test_keyword_tags_random(spark):
    words = ["Java", "JavaScript", "SQL", "MySQL", "Git", "Go", "C", "R", "Node.js", "AI"]
    alphabet = ["java", "Script", "sql", "my", "git", "go", "c", "r", "node", ".js", " ", "ai", "x"]
    for t, got in run(spark, texts(5, alphabet, 12), match.keyword_tags("t", words)):
        assert got == rules.listed_words(t, words), repr(t)
