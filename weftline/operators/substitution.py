"""Substitution by each owner's own table, the longest match at each place, with particles that agree.

Rows of texts and of tables meet by owner, tables first, in sorted partitions: a task holds one
owner's automaton (a trie with failure links) at a time and streams that owner's texts past it. Owners
with many texts are dealt into parts, each with a copy of the table.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import text as texts_
from weftline.functions.text import FINALS, HANGUL_BASE, HANGUL_LAST, PARTICLES
from weftline.plans.shared import join_checked, materialize

#: Texts of an owner that one task takes.
PART = 50_000
_PAIRS = {p: v for v in PARTICLES.values() for p in v}
_MARKS = sorted(_PAIRS, key=lambda p: (-len(p), p))


def _syllable(c: str) -> bool:
    return HANGUL_BASE <= ord(c) <= HANGUL_LAST


def _closed(word: str) -> bool:
    return bool(word) and _syllable(word[-1]) and (ord(word[-1]) - HANGUL_BASE) % FINALS > 0


def converter(pairs: list[tuple[int, str, str]], agree: bool):
    """A function of a text: stages in order, each an automaton over its forms; of a form's several targets the least counts."""
    import ahocorasick

    stages: dict[int, dict[str, str]] = {}
    for stage, form, target in sorted(pairs, reverse=True):
        stages.setdefault(stage, {})[form] = target
    machines = []
    for stage in sorted(stages):
        machine = ahocorasick.Automaton()
        for form, target in stages[stage].items():
            machine.add_word(form, (len(form), target))
        machine.make_automaton()
        machines.append(machine)

    def once(machine, text: str) -> str:
        out, last, again = [], 0, True
        while again and last < len(text):
            again = False
            for end, (size, target) in machine.iter_long(text, last):
                out += [text[last : end - size + 1], target]
                last = end + 1
                mark = next((m for m in _MARKS if text.startswith(m, last)), None) if agree else None
                after = last + len(mark or "")
                if mark and not (after < len(text) and _syllable(text[after])):
                    out.append(_PAIRS[mark][0 if _closed(target) else 1])
                    last, again = after, True  # the search goes on behind the particle
                    break
        return "".join([*out, text[last:]])

    def convert(text: str | None) -> str | None:
        for machine in machines if text else ():
            text = once(machine, text)
        return text

    return convert


def _streamed(text: str, agree: bool):
    def run(batches):
        key, pairs, convert = None, [], None
        for batch in batches:
            col = lambda n: batch.column(batch.schema.get_field_index(n)).to_pylist()
            owners, parts, tables, stages, forms, targets, texts = map(col, ("__owner", "__part", "__table", "__stage", "__form", "__target", text))
            rows, made = [], []
            for i, at in enumerate(zip(owners, parts, strict=True)):
                if at != key:
                    key, pairs, convert = at, [], None
                if tables[i] == 0:
                    pairs.append((stages[i], forms[i], targets[i]))
                    continue
                convert = convert or converter(pairs, agree)
                rows.append(i)
                made.append(convert(texts[i]))
            kept = batch.take(pa.array(rows, pa.int64())) if rows else batch.slice(0, 0)
            kept = kept.set_column(kept.schema.get_field_index(text), text, pa.array(made, pa.string()))
            yield kept.select([n for n in kept.schema.names if n not in ("__owner", "__part", "__table", "__stage", "__form", "__target")])

    return run


def replaced_by_owner(texts: DataFrame, names: DataFrame, owner: str, text: str, agree: bool = True, part: int = PART) -> DataFrame:
    """``texts`` with the forms of its owner's table replaced in ``text``: left to right, the longest form at each place.

    ``names``: (owner, form, target) and, where dictionaries are chained, ``stage``; stages run in
    order on what the one before has made. With ``agree`` a particle that ends its word right after a
    replaced form agrees with the target's final consonant. Null and empty forms and null targets are left
    out, texts without an owner or of one without a table stay as they are, nulls too.
    """
    stage = F.col("stage").cast("int") if "stage" in names.columns else F.lit(0)
    held = names.where(F.col(owner).isNotNull() & (F.coalesce("form", F.lit("")) != "") & F.col("target").isNotNull())
    held = held.select(F.col(owner).alias("__owner"), stage.alias("__stage"), F.col("form").alias("__form"), F.col("target").alias("__target")).distinct()
    schema = texts.schema
    many = texts.groupBy(F.col(owner).alias("__hot")).agg(F.count("*").alias("__n")).where((F.col("__n") > part) & F.col("__hot").isNotNull())
    many = materialize(many.select("__hot", F.ceil(F.col("__n") / part).cast("int").alias("__parts")), "owners")
    count = F.coalesce("__parts", F.lit(1))
    table = join_checked(held, many, F.col("__owner") == F.col("__hot"), "left").select("__owner", F.explode(F.sequence(F.lit(0), count - 1)).alias("__part"), F.lit(0).alias("__table"), "__stage", "__form", "__target")
    mine = texts.where(F.col(owner).isNotNull()).withColumn("__place", F.monotonically_increasing_id())
    mine = join_checked(mine, many, F.col(owner) == F.col("__hot"), "left").withColumns({"__owner": F.col(owner), "__part": F.pmod(F.xxhash64("__place"), count).cast("int"), "__table": F.lit(1)}).drop("__hot", "__parts", "__place")
    both = table.unionByName(mine, allowMissingColumns=True).repartition("__owner", "__part").sortWithinPartitions("__owner", "__part", "__table")
    out = both.select(*schema.names, "__owner", "__part", "__table", "__stage", "__form", "__target").mapInArrow(_streamed(text, agree), schema)
    return out.unionByName(texts.where(F.col(owner).isNull()))


def name_forms(names: DataFrame, owner: str, name: str, target: str, suffixes: list[str]) -> DataFrame:
    """(owner, form, target, place): a name, its parts of two or more characters, and each of them with every suffix; place from 1, the longest first, then by text."""
    each = names.select(owner, F.explode(texts_.name_forms(F.col(name), suffixes)).alias("form"), F.col(target).alias("target")).where("form <> ''").groupBy(owner, "form").agg(F.min("target").alias("target"))
    return each.withColumn("place", F.row_number().over(Window.partitionBy(owner).orderBy(F.desc(F.length("form")), "form")))
