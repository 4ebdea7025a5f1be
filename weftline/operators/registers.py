"""Speech rewritten from register to register over Hangul jamo.

Texts are split into jamo (canonical decomposition), where a final consonant is a letter of its own:
"ㅂ니다" is then an ordinary ending, whatever syllable carries the consonant, and a rule may take it
off, change it or put one on. Rules are patterns of a sentence's end, run by Spark in their order; the
result is composed to syllables again. The tables of rules are arguments.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Final consonants in the order of their jamo, the first of which is U+11A8; marks that end a sentence.
FINAL_LETTERS = "ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ"
MARKS = ".!?…~"
#: A final consonant of any kind, for the patterns of rules.
ANY_FINAL = "[ᆨ-ᇂ]"


def jamo(rule: str) -> str:
    """A pattern or replacement in jamo: syllables are decomposed, single consonants are final ones."""
    return "".join(chr(0x11A8 + FINAL_LETTERS.index(c)) if c in FINAL_LETTERS else unicodedata.normalize("NFD", c) for c in rule)


def _normalized(c: Column, form: str) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize(form, t))

    return run(c)


def split_jamo(c: Column) -> Column:
    return _normalized(c, "NFD")


def composed(c: Column) -> Column:
    return _normalized(c, "NFC")


@dataclass(frozen=True)
class Rule:
    """An ending (a pattern; ``$1`` in what it becomes is its first group), what it becomes, and what a question becomes, if that differs."""

    ending: str
    made: str
    asked: str | None = None


def step(sentence: Column, question: Column, rules: list[Rule]) -> Column:
    """A sentence in jamo by the first rule whose ending fits; null if none does."""
    out = F.lit(None).cast("string")
    for r in reversed(rules):
        end = f"(?:{jamo(r.ending)})$"
        put = lambda t: F.regexp_replace(sentence, end, jamo(t))  # noqa: B023, E731
        made = put(r.made) if r.asked is None else F.when(question, put(r.asked)).otherwise(put(r.made))
        out = F.when(sentence.rlike(end), made).otherwise(out)
    return out


def rewritten_speech(c: Column, chain: list[list[Rule]]) -> tuple[Column, Column]:
    """(pieces, text) of a text: each register of ``chain`` is derived from the one before, sentence by sentence.

    ``pieces`` is to be made a column named ``pieces`` first, from which ``text`` is computed: sentences
    with their marks, joined by a space. The text is null if it is null, has no sentence, or one of its
    sentences fits no rule of some register.
    """
    pieces = F.regexp_extract_all(split_jamo(c), F.lit(f"[^{MARKS}\n]+[{MARKS}]*"), F.lit(0))
    trimmed = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")

    bare = lambda p: trimmed(F.regexp_replace(p, f"[{MARKS}]+$", ""))
    pair = lambda text, marks: F.struct(text.alias("text"), marks.alias("marks"))
    # Each register is a pass over the sentences of the one before, so that no rule holds another register's rules.
    done = F.filter(F.transform("pieces", lambda p: pair(bare(p), F.regexp_extract(p, f"([{MARKS}]*)$", 1))), lambda x: x["text"] != "")
    for rules in chain:
        done = F.transform(done, lambda x: pair(step(x["text"], F.contains(x["marks"], F.lit("?")), rules), x["marks"]))  # noqa: B023
    made = F.transform(done, lambda x: F.concat(x["text"], x["marks"]))
    whole = (F.size(made) > 0) & ~F.exists(made, lambda x: x.isNull())
    return pieces, composed(F.when(whole, F.array_join(made, " ")))
