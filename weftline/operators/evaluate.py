"""Rule checks of model output."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def top_word_share(c: Column) -> Column:
    """The share of the most frequent word: the longest run among the sorted words; null without words."""
    words = F.array_sort(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != ""))
    start = F.struct(F.lit("").alias("w"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(a, w):
        run = F.when(a["w"] == w, a["run"] + 1).otherwise(1)
        return F.struct(w.alias("w"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

    best = F.aggregate(words, start, step, lambda a: a["best"])
    return F.when(F.size(words) > 0, best / F.size(words))


#: Characters with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@F.pandas_udf(StringType())
def degenerate(s: pd.Series) -> pd.Series:
    """empty_response, repetition_collapse (over 0.4 one word of at least 5), character_collapse (under 0.15 distinct of at least 10), or null.

    An Arrow function: built-in functions would sort a text's words and hold a string for each of its characters.
    """
    gap = re.compile(f"[{WHITE}]+")

    def kind(text):
        words = [w for w in gap.split(text or "") if w]
        if not words:
            return "empty_response"
        if len(words) >= 5 and max(Counter(words).values()) / len(words) > 0.4:
            return "repetition_collapse"
        inner = text[text.index(words[0]) : text.rindex(words[-1]) + len(words[-1])]
        return "character_collapse" if len(inner) >= 10 and len(set(inner)) / len(inner) < 0.15 else None

    return s.map(kind)


def first_hit(c: Column, patterns: list[str]) -> Column:
    """The first of the patterns that occurs in the lower-cased text, or null."""
    found = F.filter(F.array(*[F.lit(p) for p in patterns]), lambda p: F.contains(F.lower(c), F.lower(p)))
    return F.get(found, F.lit(0))


def required_groups(c: Column, groups: list[list[str]]) -> Column:
    """Whether every group has a text that occurs, all without white space."""
    plain = F.regexp_replace(c, r"(?U)\s+", "")
    out = F.lit(True)
    for g in groups:
        any_ = F.lit(False)
        for t in g:
            any_ = any_ | plain.contains("".join(t.split()))
        out = out & any_
    return out


def number_answer(c: Column, counters: list[str] = [], words: dict[str, int] = {}) -> Column:
    """The number that is the whole answer, but for a counter behind it and marks at its end; a word may stand for one; else null."""
    plain = F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", ""), "[.!。]*$", "")
    counter = "(?:" + "|".join(rf"\Q{x}\E" for x in counters) + ")?" if counters else ""
    out = F.nullif(F.regexp_extract(plain, rf"^(\d{{1,18}}){counter}$", 1), F.lit("")).try_cast("long")
    for word, n in words.items():
        out = F.when(plain == word, F.lit(n).cast("long")).otherwise(out)
    return out


def objective_score(answer: Column, expected: int) -> Column:
    """1 for the expected number, 0 for another, null where the answer is none and must be read."""
    return F.when(answer.isNotNull(), (answer == expected).cast("double"))


def verdict(score: Column) -> Column:
    return F.when(score == 1.0, "PASS").when(score == 0.0, "FAIL").otherwise("NEEDS_REVIEW")
