"""Globs against the standard library's."""

from __future__ import annotations

import fnmatch

from pyspark.sql import functions as F

from fleetmeter.functions.columns import glob_to_regex

PATTERNS = [
    "[z-a]", "[!z-a]", "a[z-ax]b", "a[!z-ax]b", "[a-c]*", "[!a-c]?", "[-a]", "[a-]", "[]a]", "[!]a]", "*", "", "a.b", "[", "a[", "x[^a]", "[a&&b]", "é*",
]
TEXTS = ["", "a", "b", "z", "x", "-", "]", "axb", "azb", "ayb", "ab", "cd", "a.b", "acb", "[", "a[", "x^", "xa", "xb", "&", "\u00e9t", "A"]


def test_globs_match_like_the_standard_ones(spark):
    pairs = spark.createDataFrame([(p, t) for p in PATTERNS for t in TEXTS], "pattern string, text string")
    regex = glob_to_regex(F.col("pattern"))
    got = {(r.pattern, r.text): r.hit for r in pairs.select("pattern", "text", F.rlike("text", regex).alias("hit")).collect()}
    assert got == {(p, t): fnmatch.fnmatchcase(t, p) for p in PATTERNS for t in TEXTS}
