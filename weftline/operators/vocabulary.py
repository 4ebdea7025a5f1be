"""Names and endings in texts: forms of address, slots for names, common turns, rewritten registers.

Languages come in as arguments: patterns, terms and tables of endings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def address_statistics(df: DataFrame, text: str, pattern: str, follow: str) -> DataFrame:
    """(base, suffix, uses, vocative_uses) of the forms that ``pattern`` finds, base and suffix being its two groups.

    A use is vocative if ``follow`` matches right behind it. Null texts have no forms.
    """
    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    called = F.regexp_extract_all(text, F.lit(f"{pattern}(?={follow})"), F.lit(0))
    marked = lambda forms, n: F.transform(forms, lambda x: F.struct(x.alias("form"), F.lit(n).alias("vocative")))
    uses = df.select(F.explode(F.concat(marked(every, 0), marked(called, 1))).alias("u"))
    # counted by form first, so that groups are found once a form and not once a use
    forms = uses.groupBy("u.form").agg(F.count_if(F.col("u.vocative") == 0).alias("uses"), F.count_if(F.col("u.vocative") == 1).alias("vocative_uses"))
    return forms.select(F.regexp_extract("form", pattern, 1).alias("base"), F.regexp_extract("form", pattern, 2).alias("suffix"), "uses", "vocative_uses")


def foreign_forms(stats: DataFrame, canon: DataFrame, names: DataFrame, evident: list[str], least: int = 3) -> DataFrame:
    """Forms of ``stats`` that ``canon`` (form) lacks or that are vocative ``least`` times, if their base is a name.

    A base is a name if it comes with one of the ``evident`` suffixes or is a word of ``names`` (word).
    """
    named = stats.where(F.col("suffix").isin(evident)).select("base").unionByName(names.select(F.col("word").alias("base"))).distinct()
    known = canon.select("form").distinct().withColumn("__known", F.lit(True))
    rows = stats.withColumn("form", F.concat("base", "suffix")).join(named, "base", "left_semi").join(known, "form", "left")
    return rows.where(F.col("__known").isNull() | (F.col("vocative_uses") >= least)).select("form", "base", "suffix", "uses", "vocative_uses")


def any_of(terms: Column) -> Column:
    """A pattern for the terms of an array, longer ones first; null if there is none. Null and empty terms are left out."""
    own = F.array_distinct(F.filter(terms, lambda t: F.length(t) > 0))
    by_length = F.transform(F.array_sort(F.transform(own, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))), lambda s: s["t"])
    escaped = F.transform(by_length, lambda t: F.regexp_replace(t, r"([\\.\[\]{}()*+?^$|-])", r"\\$1"))
    return F.when(F.size(own) > 0, F.concat(F.lit("(?:"), F.array_join(escaped, "|"), F.lit(")")))


def slotted(c: Column, slots: list[tuple[Column, str]], follow: str = "") -> Column:
    """``c`` with the terms of each row's arrays replaced by their slot, slot after slot; ``follow`` is a pattern of what may come behind a term."""
    for terms, slot in slots:
        behind = f"(?={follow})" if follow else ""
        c = F.coalesce(F.regexp_replace(c, F.concat(any_of(terms), F.lit(behind)), F.lit(slot)), c)
    return c


def is_common_turn(segments: Column, banned: list[str], word: str, stem, vocabulary: list[str]) -> Column:
    """Whether a turn has segments, none matches a ``banned`` pattern and no ``stem`` of a ``word`` in them is in ``vocabulary``."""
    bad = lambda s: F.greatest(*[F.coalesce(s.rlike(p), F.lit(False)) for p in [*banned, "(?!)"]], F.lit(False))
    words = F.flatten(F.transform(segments, lambda s: F.coalesce(F.regexp_extract_all(s, F.lit(word), F.lit(0)), F.array().cast("array<string>"))))
    setting = F.array(*map(F.lit, vocabulary)) if vocabulary else F.array().cast("array<string>")
    return F.coalesce((F.size(segments) > 0) & ~F.exists(segments, bad) & ~F.arrays_overlap(F.transform(words, stem), setting), F.lit(False))


def rewritten_ending(c: Column, exact: dict[str, str], endings: list[tuple[str, str]], keep: list[str] = []) -> Column:
    """A sentence in another register: kept if it ends so already, by the table of whole sentences, else by the first ending that fits; null if none does.

    Endings are patterns of the sentence's end, and replacements may use their groups. Tables of two
    registers chain: ``rewritten_ending(rewritten_ending(c, ...), ...)``.
    """
    out = F.when(F.lit(False), c)
    for ending in keep:
        out = out.when(F.endswith(c, F.lit(ending)), c)
    for source, target in exact.items():
        out = out.when(c == source, F.lit(target))
    for source, target in endings:
        out = out.when(c.rlike(rf"(?:{source})\z"), F.regexp_replace(c, rf"(?:{source})\z", target))
    return out


def rewritten_text(sentences: Column, rewrite) -> Column:
    """The sentences of a text rewritten one by one and joined; null if there are none or one of them cannot be derived."""
    done = F.transform(F.filter(sentences, lambda s: F.length(F.trim(s)) > 0), lambda s: rewrite(F.trim(s)))
    return F.when((F.size(done) > 0) & ~F.exists(done, lambda s: s.isNull()), F.array_join(done, " "))
