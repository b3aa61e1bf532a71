"""Rules looked up by required literals: necessary literals, the same answers, time that does not follow the rules."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from utterspark.functions.literals import required_literal
from utterspark.operators import features as FT

KIND = "priority int, pattern string, intent string"


@pytest.mark.parametrize("pattern,want", [
    ("hello", "hello"), ("^hel+o wor?ld$", "o wo"), ("a|bcd", None), ("(a|b)cde(f)", "cde"), ("[abc]+def", "def"), ("x*yz", "yz"), ("ab{0,3}cdef", "cdef"),
    ("ab{2}", "ab"), (r"\bcat\b", "cat"), (r"\d+ apples\.", " apples."), (r"\x41bcd", "bcd"), (r"\x{1F600}bcd", "bcd"), (r"Abc", "Abc"), (r"\p{L}qrs", "qrs"),
    (r"\pLqrs", "qrs"), (r"a\1bcd", "bcd"), ("(?i)hello", None), ("(?s)hello.*you", "hello"), ("(?-i)x", None), (r"\Qa.b\E", None), ("[]a]bc", None), ("中", "中"),
    ("z", None), ("", None), ("ab(", None), ("ab)", None), ("a{", None), ("*a", None), (r"ab\\", "ab\\"), ("ab\\", None), ("[a[bc]d]efg", "efg"), (r"[\]]efg", "efg"),
    ("(a(b)[)]c)def", "def"), ("abc+?d", "abc"), ("ab++cd", "ab"), ("(?=abc)defg", "defg"), ("a.b.cde", "cde"), (r"\k<n>xy", "xy"), (r"ab\tcd", "ab"),
])
def test_required_literal(pattern, want):
    assert required_literal(pattern) == want


def test_a_match_always_holds_its_literal():
    r = random.Random(4)
    atoms = ["a", "b", "cd", "e+", "f*", "g?", "h{2}", "i{0,2}", "[jk]", "(l|m)", "(no)?", ".", r"\.", r"\d", "p{1,}", "q+?"]
    seen = 0
    for _ in range(3_000):
        pattern = "".join(r.choice(atoms) for _ in range(r.randrange(2, 5)))
        literal = required_literal(pattern)
        if literal is None:
            continue
        for _ in range(20):
            text = "".join(r.choice("abcdefghijklmnopq.12") for _ in range(r.randrange(200)))
            m = re.search(pattern, text)
            if m:
                seen += 1
                assert literal in m.group(0), (pattern, text)
    assert seen > 100


def many(n, seed=1):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    shapes = ["{w}", "(^|[^a-z]){w}([^a-z]|$)", "{w}.*x", "^{w}", "[a-d]+{w}?", "{w}|zz", "(?i){w}", "{w}+ "]
    return [(i // 3, r.choice(shapes[:4] if i % 50 else shapes).format(w=w), f"i{i % 97}") for i, w in enumerate(words)], words


def texts_of(spark, words, n=300, seed=2):
    r = random.Random(seed)
    rows = [(i, " ".join(r.choice(words) if r.random() < 0.3 else "".join(r.choice("abcdefghx") for _ in range(6)) for _ in range(r.randrange(12)))) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None), (n + 1, "")], "id int, text string").repartition(4)


def answers(df):
    return sorted((r.id, r.rule_intent, r.rule_priority) for r in df.select("id", "rule_intent", "rule_priority").collect())


def test_the_answers_are_those_of_trying_every_rule(spark, monkeypatch):
    rules, words = many(600)
    df, table = texts_of(spark, words), spark.createDataFrame(rules, KIND)
    got = FT.rule_match(df, table)
    assert got.columns == ["id", "text", "rule_intent", "rule_priority"]
    looked_up = answers(got)
    monkeypatch.setattr(FT, "FEW_RULES", 10**9)
    assert looked_up == answers(FT.rule_match(df, table))
    assert len({r[1] for r in looked_up}) > 20 and any(r[1] is None for r in looked_up)


def test_priorities_over_both_kinds_of_rules(spark, monkeypatch):
    monkeypatch.setattr(FT, "FEW_RULES", 0)
    df = spark.createDataFrame([(1, "say hello 7"), (2, "hello"), (3, "7"), (4, "x"), (5, None)], "id int, text string")
    rules = [(2, "hello", "greet"), (1, "[0-9]", "digit"), (3, "ello|x", "any"), (2, "hell", "first")]
    got = answers(FT.rule_match(df, spark.createDataFrame(rules, KIND)))
    assert got == [(1, "digit", 1), (2, "first", 2), (3, "digit", 1), (4, "any", 3), (5, None, None)]
    for some in (rules[:1], rules[1:2], []):
        assert len(answers(FT.rule_match(df, spark.createDataFrame(some, KIND)))) == 5


def test_time_hardly_depends_on_the_number_of_rules(spark):
    took = {}
    for n in (200, 20_000):
        rules, words = many(n)
        rules = [r for r in rules if "|zz" not in r[1] and "(?i)" not in r[1] and "]+" not in r[1]]
        df = texts_of(spark, words[:200], 2_000).cache()
        df.count()
        out = FT.rule_match(df, spark.createDataFrame(rules, KIND))
        out.agg(F.count("rule_intent")).collect()
        began = time.perf_counter()
        out.agg(F.count("rule_intent")).collect()
        took[n] = time.perf_counter() - began
    assert took[20_000] < 10 * took[200] + 1, took


def test_rules_behind_the_first_that_matches_cost_nothing(spark):
    words = ["".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(1_500)]
    rules = spark.createDataFrame([(i, f"(^|[^a-z]){w}([^a-z]|$)", w) for i, w in enumerate(words)], KIND)
    df = spark.createDataFrame([(i, " ".join(words)) for i in range(300)], "id int, text string").repartition(4).cache()
    df.count()
    out = FT.rule_match(df, rules)
    out.limit(1).collect()
    began = time.perf_counter()
    assert {(r.rule_intent, r.rule_priority) for r in out.select("rule_intent", "rule_priority").collect()} == {(words[0], 0)}
    assert time.perf_counter() - began < 6
