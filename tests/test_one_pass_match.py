"""Dictionaries found in one pass against a scan per word, also where words hold one another."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from posting_analytics.functions import match

EDGE = "abcdefghijklmnopqrstuvwxyz0123456789_"


def plain_found(text, words, whole_word):
    text = text.lower()

    def occurs(word):
        at = text.find(word)
        while at >= 0:
            before, after = text[at - 1:at] if at else "", text[at + len(word):at + len(word) + 1]
            if not whole_word or not ((before and before in EDGE) or (after and after in EDGE)):
                return True
            at = text.find(word, at + 1)
        return False

    return [w for w in words if occurs(w.lower())]


def _cases(seed, n_words):
    rng = random.Random(seed)
    words = list(dict.fromkeys("".join(rng.choice("ab+c. é") for _ in range(rng.randrange(1, 5))).strip() or "a"
                               for _ in range(n_words)))
    texts = ["".join(rng.choice("abAB+c. é-1") for _ in range(rng.randrange(30))) for _ in range(120)]
    return words, texts + ["", " ".join(words), "".join(words)]


@pytest.mark.parametrize("whole_word", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_words_found(spark, seed, whole_word):
    words, texts = _cases(seed, 40)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", match.words_found(F.lower("t"), words, whole_word).alias("w")).collect()
    for r in got:
        assert list(r.w) == plain_found(texts[r.i], words, whole_word), texts[r.i]


@pytest.mark.parametrize("whole_word", [False, True])
def test_tags_and_labels_do_not_depend_on_the_way(spark, whole_word, monkeypatch):
    words, texts = _cases(7, 30)
    words = [w.upper() if i % 3 else w for i, w in enumerate(dict.fromkeys(w.lower() for w in words))]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    rules = [(w, f"label {i}") for i, w in enumerate(words)]

    def read():
        return df.select(match.keyword_tags("t", words, 4, whole_word=whole_word),
                         match.ordered_label("t", rules, "none", whole_word)).collect()

    monkeypatch.setattr(match, "ONE_PASS_FROM", {False: 0, True: 0})
    one_pass = read()
    monkeypatch.setattr(match, "ONE_PASS_FROM", {False: 10 ** 9, True: 10 ** 9})
    assert one_pass == read()
    assert one_pass[-1][0] == match.vocab.NOT_FOUND and one_pass[-1][1] == "none"


def test_words_that_hold_one_another(spark):
    df = spark.createDataFrame([("I use JavaScript, C++ and Node.js",)], "t string")
    words = ["java", "script", "javascript", "c", "c++", "node", "node.js", "js"]
    assert df.select(match.words_found(F.lower("t"), words)).first()[0] == words
    assert df.select(match.words_found(F.lower("t"), words, True)).first()[0] == [
        "javascript", "c", "c++", "node", "node.js", "js"]


def test_repeated_words_of_a_list(spark):
    df = spark.createDataFrame([("a b",)], "t string")
    words = ["B", "b", "a", *[f"w{i}" for i in range(20)]]
    assert df.select(match.keyword_tags("t", words)).first()[0] == "B, b, a"


@pytest.mark.parametrize("whole_word", [False, True])
def test_three_hundred_words_cost_little_more_than_thirty(spark, whole_word):
    rng = random.Random(5)
    syllables = ["th", "an", "er", "in", "on", "es", "re", "st"]
    words = list(dict.fromkeys("".join(rng.choice(syllables) for _ in range(4)) for _ in range(400)))[:300]
    texts = [(" ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 6))) for _ in range(400)),)
             for _ in range(400)]
    df = spark.createDataFrame(texts, "t string").repartition(4).cache()
    df.count()

    def seconds(n):
        best = 1e9
        for _ in range(3):
            begin = time.time()
            df.select(F.max(match.keyword_tags("t", words[:n], whole_word=whole_word))).collect()
            best = min(best, time.time() - begin)
        return best

    assert seconds(300) < 3 * seconds(30) + 0.3


def test_pattern_branches_once_per_character():
    assert match._trie_pattern(["ab", "abc", "abd", "x.y"]) == r"(?:ab(?:c|d)?|x\.y)"
    assert re.match(match._trie_pattern(["a", "aab"]), "aab").group() == "aab"
