"""Audits of dialogue patterns: what a turn holds that it should not, and what is wrong with a whole pattern.

Each check gives the text that it found, or null. Word lists, names and slots are arguments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import quote
from weftline.plans.shared import join_checked, materialize

#: A slot, one slot after another, and letters of the Japanese syllabaries.
SLOT, DOUBLED, KANA = r"\{[a-z]+\}", r"(\{[a-z]+\})\s*\1", "[ぁ-ゖァ-ヺ]+"


def _found(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), pattern, 0), F.lit(""))


def pattern_hit(c: Column, pattern: str) -> Column:
    return _found(c, pattern)


def marker_hit(c: Column, markers: list[str]) -> Column:
    """The first of the markers, in their order, that occurs."""
    return F.get(F.filter(F.array(*map(F.lit, markers)), lambda m: F.contains(c, m)), F.lit(0))


def kana_hit(c: Column) -> Column:
    return _found(c, KANA)


def slot_problem(segments: Column, known: list[str], honorifics: list[str]) -> Column:
    """In the first segment that has one: a slot that is not known, else a slot with an honorific, else a doubled slot."""
    slots = F.array(*map(F.lit, known))
    ends = "|".join(map(quote, honorifics))

    def one(s: Column) -> Column:
        other = F.get(F.filter(F.regexp_extract_all(s, F.lit(SLOT), F.lit(0)), lambda x: ~F.array_contains(slots, x)), F.lit(0))
        return F.coalesce(other, *([_found(s, rf"{SLOT}(?:{ends})")] if honorifics else []), _found(s, DOUBLED))

    return F.get(F.filter(F.transform(segments, one), lambda x: x.isNotNull()), F.lit(0))


def own_slot(role: Column, c: Column, slots: dict[str, str]) -> Column:
    """The slot of a role in that role's own turn."""
    out = F.lit(None).cast("string")
    for name, slot in slots.items():
        out = F.when((role == name) & F.contains(c, F.lit(slot)), F.lit(slot)).otherwise(out)
    return out


def source_term(c: Column, sources: list[str], targets: list[str]) -> Column:
    """A term that should have been corrected, found outside what corrections write; the longest first at each place."""
    longest = lambda terms: "|".join(map(quote, sorted(terms, key=lambda t: (-len(t), t))))
    rest = F.regexp_replace(c, longest(targets), " ") if targets else c
    return _found(rest, longest(sources)) if sources else F.lit(None).cast("string")


def address_hit(c: Column, form: str, endings: list[str], own: list[str]) -> Column:
    """The first address form (a pattern of name and ending) with one of the endings that is not of the own forms."""
    forms = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(form), F.lit(0))
    foreign = lambda x: ~F.array_contains(F.array(F.lit(""), *map(F.lit, own)), x) & F.exists(F.array(*map(F.lit, endings)), lambda e: F.endswith(x, e))
    return F.get(F.filter(forms, foreign), F.lit(0))


def foreign_names(turns: DataFrame, names: DataFrame, key: list[str], text: str, word: str, stem) -> DataFrame:
    """(key, word): the first word of each turn that is a name, or whose stem is one; names (name) are joined, not collected."""
    words = turns.select(*key, F.posexplode(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(word), F.lit(0))).alias("__at", "word"))
    each = words.select(*key, "__at", "word", F.explode(F.array_distinct(F.array(F.col("word"), stem(F.col("word"))))).alias("__name"))
    known = materialize(names.select(F.col("name").alias("__n")).distinct(), "names")
    hits = join_checked(each, known, F.col("__name") == F.col("__n"), "left_semi")
    return hits.groupBy(*key).agg(F.min_by("word", "__at").alias("word"))


def structure_problem(turns: Column, first: str, last: str, roles: list[str]) -> Column:
    """What is wrong with the turns (role, segments) of a pattern: roles at its ends, an unknown role, an empty segment, an empty turn; null if nothing is."""
    end = lambda i: F.coalesce(F.element_at(turns, i)["role"], F.lit(""))
    none = F.coalesce(F.size(turns), F.lit(0)) <= 0
    ends = none | F.when(~none, (end(1) != first) | (end(-1) != last))
    blank = lambda t: F.exists(t["segments"], lambda s: F.trim(F.coalesce(s, F.lit(""))) == "")
    unknown = F.exists(turns, lambda t: ~F.coalesce(t["role"].isin(*roles), F.lit(False)))
    return F.when(ends, "roles").when(unknown, "unknown_role").when(F.exists(turns, blank), "empty_segment").when(F.exists(turns, lambda t: F.coalesce(F.size(t["segments"]), F.lit(0)) <= 0), "empty_turn")


def field_problem(situation: Column, topic: Column, level: Column, topics: dict[str, str], levels: list[str]) -> Column:
    """situation, topic or level, whichever first is not what it may be; each situation has one topic."""
    due = F.lit(None).cast("string")
    for s, t in topics.items():
        due = F.when(situation == s, F.lit(t)).otherwise(due)
    return F.when(due.isNull(), "situation").when(~topic.eqNullSafe(due), "topic").when(~F.coalesce(level.isin(*levels), F.lit(False)), "level")
