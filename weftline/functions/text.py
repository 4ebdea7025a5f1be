"""Text functions: Column in, Column out. Arrow functions only where Spark has no builtin."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values of the source texts' formats.
CONTROL_TAGS = ("font", "sound", "effect", "camera", "transition", "motionway", "display")
SENTENCE_MARKS = ".!?…~♪♡♥★"
HANGUL_BASE, HANGUL_LAST, FINALS = 0xAC00, 0xD7A3, 28


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Canonical composition; a text that is already composed is passed on."""
    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


#: The characters that Unicode calls white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


#: Those that Unicode calls spaces, which SQL's trim takes: no tabs and no ends of lines.
SPACES = " \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.trim(c, F.lit(WHITE))


def normalize_text(c: Column) -> Column:
    """NFC, line feeds for CRLF and CR, stripped; null becomes empty."""
    return strip(F.regexp_replace(nfc(F.coalesce(c, F.lit(""))), "\r\n?", "\n"))


def is_empty_text(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"(?U)^\s*$")


def collapse_space(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def clean_script_text(c: Column) -> Column:
    """Normalised text without control tags and without timing codes at line ends, on one line."""
    plain = F.regexp_replace(normalize_text(c), "<(?:" + "|".join(CONTROL_TAGS) + ")(?::[^<>]*)?>", "")
    return collapse_space(F.regexp_replace(plain, r"(?dm)(?:[ \t]*@-?\d+(?:\.\d+)?)+[ \t]*$", ""))


def is_placeholder(c: Column, texts: tuple[str, ...], labels: tuple[str, ...]) -> Column:
    """One of the fixed texts, or a label followed by an underscore."""
    return c.isin(*texts) | c.rlike("^(?:" + "|".join(map(quote, labels)) + ")[_＿]")


def quote(text: str) -> str:
    """A pattern that matches just ``text``."""
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def is_quoted(c: Column) -> Column:
    return (F.length(c) >= 2) & c.startswith('"') & c.endswith('"')


def unquote(c: Column, white: str = WHITE) -> Column:
    return F.when(is_quoted(c), F.trim(F.substring(c, F.lit(2), F.length(c) - 2), F.lit(white))).otherwise(c)


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def join_cjk(c: Column) -> Column:
    """Without white space between two characters that are not ASCII."""
    return F.regexp_replace(c, r"(?<=[^\x00-\x7F])\s+(?=[^\x00-\x7F])", "")


def masked_entity(c: Column) -> Column:
    return c.rlike(r"@[^@\s]{1,20}@")


def clean_roleplay(c: Column, emoticons: str = "[ㅋㅎㅠㅜ^]{2,}") -> Column:
    """Stage directions and quotes become spaces, emoticon runs go, white space collapses."""
    plain = F.regexp_replace(F.regexp_replace(c, r"\*[^*]*\*", " "), '"', " ")
    return collapse_space(F.regexp_replace(plain, emoticons, ""))


def sentences(c: Column) -> Column:
    """Sentences without the marks, brackets and quotes at their ends; none empty."""
    found = F.split(F.coalesce(c, F.lit("")), f"[{SENTENCE_MARKS}]+")  # extracting all matches costs the text's length for each
    bare = F.transform(found, lambda s: F.rtrim(strip(s), F.lit(SENTENCE_MARKS + " )\"'")))
    return F.filter(bare, lambda s: s != "")


def first_match(c: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The label of the first rule (label, pattern) that is found in the text."""
    return reduce(lambda rest, rule: F.when(c.rlike(rule[1]), F.lit(rule[0])).otherwise(rest), reversed(rules), F.lit(default))


# The endings that decide a sentence's register and their order. Other endings or another order give other registers.
LEVELS = [
    ("military", "(슴다|슴까|임다|임까|심다|심까|십쇼|겠슴|했슴|았슴|었슴)$"),
    ("formal", "(니다|니까|십시오|옵니다|사옵|시지요)$"),
    ("archaic", "(하오|이오|구려|시오|겠소|했소|었소|았소|이라오|라오|느냐|거라|노라)$"),
    ("polite", "(요|죠)$"),
]


def speech_level(c: Column) -> Column:
    return first_match(c, LEVELS, "casual")


def segments(c: Column) -> Column:
    """Parts of a turn in order: (kind, text), an action between asterisks or the speech around it; none empty. An asterisk without a second is speech."""
    parts = F.regexp_extract_all(c, F.lit(r"(\*[^*]*\*|[^*]+(?:\*(?![^*]*\*)[^*]*)?|\*(?![^*]*\*)[^*]*)"), F.lit(1))
    action = lambda p: (F.length(p) >= 2) & p.startswith("*") & p.endswith("*")
    speech = lambda p: strip(F.regexp_replace(strip(p), '^["“”]+|["“”]+$', ""))
    made = F.transform(
        parts,
        lambda p: F.struct(F.when(action(p), "action").otherwise("speech").alias("kind"), F.when(action(p), strip(F.substring(p, F.lit(2), F.length(p) - 2))).otherwise(speech(p)).alias("text")),
    )
    return F.filter(made, lambda s: s["text"] != "")


def final_consonant(c: Column) -> Column:
    """Number of the last syllable's final consonant; 0 without one or if it is no Hangul syllable."""
    code = F.ascii(F.substring(c, -1, 1))
    return F.when(code.between(HANGUL_BASE, HANGUL_LAST), (code - HANGUL_BASE) % FINALS).otherwise(0)


#: Particles after a final consonant and after none.
PARTICLES = {"topic": ("은", "는"), "subject": ("이", "가"), "object": ("을", "를"), "with": ("이랑", "랑"), "vocative": ("아", "야"), "copula": ("이에요", "예요")}


def with_particle(c: Column, kind: str) -> Column:
    closed, open_ = PARTICLES[kind]
    return F.concat(c, F.when(final_consonant(c) > 0, closed).otherwise(open_))


def word_stem(c: Column, suffixes: list[str]) -> Column:
    """Without the first suffix of the list that fits and leaves two characters."""
    cut = lambda s: (c.endswith(s)) & (F.length(c) - len(s) >= 2)
    return reduce(lambda rest, s: F.when(cut(s), F.substring(c, F.lit(1), F.length(c) - len(s))).otherwise(rest), reversed(suffixes), c)


def preview(c: Column, n: int = 80) -> Column:
    return F.substring(c, 1, n)


def call_name(c: Column) -> Column:
    return strip(F.split(c, r"\(")[0])


def collapse_slots(c: Column) -> Column:
    """A slot such as {s} that follows itself is written once."""
    return F.regexp_replace(c, r"(\{[a-z]+\})(?:\s*\1)+", "$1")


def corrected(c: Column, pairs: list[tuple[str, list[str]]]) -> Column:
    """An ordered fold over (target, sources): each source becomes the target."""
    return reduce(lambda out, p: reduce(lambda o, s: F.replace(o, F.lit(s), F.lit(p[0])), p[1], out), pairs, c)


def section_after(c: Column, marker: str) -> Column:
    """The first non-empty line after the line that equals ``marker``."""
    lines = F.transform(F.split(c, "\n"), strip)
    at = F.array_position(lines, marker)
    rest = F.filter(F.slice(lines, at.cast("int") + 1, F.size(lines) + 1), lambda s: s != "")
    return F.when(at > 0, F.get(rest, F.lit(0)))


def name_forms(name: Column, suffixes: list[str]) -> Column:
    """A name, its parts of two or more characters, and each with every suffix."""
    parts = F.filter(F.split(name, r"\s+"), lambda p: F.length(p) >= 2)
    forms = F.array_distinct(F.concat(F.array(name), parts))
    return F.array_distinct(F.flatten(F.transform(forms, lambda f: F.array(f, *[F.concat(f, F.lit(s)) for s in suffixes]))))


def quoted_parts(c: Column) -> Column:
    """Top-level quoted parts of a text with nested quotes and glosses in brackets taken out (Arrow)."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        def parts(t):
            if t is None:
                return None
            out, depth, gloss, held = [], 0, 0, []
            for ch in t:
                if ch == "(":
                    gloss += 1
                elif ch == ")" and gloss:
                    gloss -= 1
                elif gloss:
                    continue
                elif ch == "“":
                    depth += 1
                elif ch == "”" and depth:
                    depth -= 1
                    if not depth:
                        out.append("".join(held).strip())
                        held = []
                elif depth:
                    held.append(ch)
            return [x for x in out if x]

        return s.map(parts)

    return run(c)
