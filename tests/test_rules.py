"""Rules that users bring: what is refused, and where."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.patterns import RuleError, check_rule
from ledgerline.functions.rules import RULES, TOTAL_RULES, java, load_rules

BAD = {
    r"a(": 1,
    r"(?P<x>a+b)+c": 10,
    r"((a|b+)x?)*": 10,
    r"x[a&&b]": 3,
    r"x[[ab]": 2,
    r"end\Z": 3,
    r"tab\v": 3,
    r"(a)(?(1)b|c)": 3,
    r"(?P<a_b>x)": 0,
    r"(?P<a>x)(?P=a)": 8,
    r"a{,3}": 1,
    r"a{x}": 1,
    r"(?#note)a": 0,
    r"(?x)a b": 0,
    r"[]a]": 1,
    r"(?:(?:a*)b)*": 11,
    r"\0": 0,
    r"\U00000041": 0,
}
GOOD = [
    r"(?>a+b)+", r"(?:a++b)+", r"(a+b){2,5}", r"(?:ab)+c+", r"a.c$", r"[^\]a-z]+", r"x{2}y{3,}z{1,4}?", r"(?s)(?i:ab)|.x",
    r"(?<=a)b(?!c)", r"\d+\.\d*", r"[\s\d]?(?P<Shprn>SH|PRN|X)", r"(a)\1", r"", r"a|", r"[a\-b&]", r"\x41é", r"(?:a?b?)+",
]


@pytest.mark.parametrize("pattern", BAD)
def test_refused(pattern):
    with pytest.raises(RuleError) as error:
        check_rule("Mine", pattern)
    assert error.value.offset == BAD[pattern] and "rule Mine" in str(error.value)


def test_the_group_is_named():
    with pytest.raises(RuleError, match=r"group word, opened at offset 1"):
        check_rule("Mine", r"x(?P<word>a+)*y")


@pytest.mark.parametrize("pattern", [*GOOD, *RULES.values(), *TOTAL_RULES.values()])
def test_taken(pattern):
    check_rule("Mine", pattern)


def test_built_in_rules_are_written_as_before():
    assert all(java(RULES[name]) == "(?i)" + RULES[name].replace("(?P<", "(?<") for name in ("CUSIP", "Shprn", "SkipL", "UseL", "StopL", "Anyopt"))


def test_what_is_taken_means_the_same(spark):
    pick = random.Random(2)
    texts = ["".join(pick.choices("abcxAB1 .]-&\x85 \n", k=pick.randrange(9))) for _ in range(400)]
    table = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    for pattern in GOOD:
        got = [r[0] for r in table.select(F.col("t").rlike(java(pattern))).collect()]
        assert got == [bool(re.search(pattern, t, re.IGNORECASE)) for t in texts], pattern


def test_refused_when_loaded(spark, tmp_path):
    (tmp_path / "rules.csv").write_text('Type,Pattern\nAnyopt,"(a+)+b"\n')
    with pytest.raises(RuleError, match="rule Anyopt"):
        load_rules(spark, f"{tmp_path}/rules.csv")


def test_long_lines_take_no_time(spark):
    line = "a" * 5_000
    began = time.time()
    table = spark.createDataFrame([(line,)], "t string")
    assert not table.select(F.col("t").rlike(java(r"(?:a++b)+c"))).first()[0] and time.time() - began < 20
