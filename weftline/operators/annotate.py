"""Joins by key: annotations that must all be used, inherited values, aliases, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def annotation_merge(records: DataFrame, notes: DataFrame, key: str) -> DataFrame:
    """Full outer join with ``state``: matched, unannotated (record alone) or unused (note alone). Keys of notes must be unique."""
    left, right = records.withColumn("__l", F.lit(True)), notes.withColumn("__r", F.lit(True))
    state = F.when(F.col("__l") & F.col("__r"), "matched").when(F.col("__l"), "unannotated").otherwise("unused")
    return left.join(right, key, "full_outer").withColumn("state", state).drop("__l", "__r")


def require_all_used(merged: DataFrame, key: str, limit: int = 5) -> None:
    """Raise if a note matched no record."""
    unused = [r[0] for r in merged.where("state = 'unused'").select(key).orderBy(key).limit(limit).collect()]
    if unused:
        raise ValueError(f"annotations without a record: {unused}")


def require_unique(df: DataFrame, key: str, what: str) -> None:
    """Raise if a key occurs twice."""
    twice = df.groupBy(key).count().where("count > 1").select(key).orderBy(key).limit(5).collect()
    if twice:
        raise ValueError(f"{what} is not unique: {[r[0] for r in twice]}")


def inherit(df: DataFrame, first: DataFrame, second: DataFrame, k1: str, k2: str, value: str) -> DataFrame:
    """``df`` with ``value`` from ``first`` by ``k1``, else from ``second`` by ``k2``."""
    a = first.select(F.col(k1).alias("__a"), F.col(value).alias("__v1"))
    b = second.select(F.col(k2).alias("__b"), F.col(value).alias("__v2"))
    out = df.join(a, F.col(k1) == F.col("__a"), "left").join(b, F.col(k2) == F.col("__b"), "left")
    return out.withColumn(value, F.coalesce("__v1", "__v2")).drop("__a", "__b", "__v1", "__v2")


def expand_aliases(rows: DataFrame, aliases: DataFrame, id_col: str, keys: str) -> DataFrame:
    """(id, keys): each record's keys and, one hop on, their aliases (key, alias); sorted and distinct."""
    each = rows.select(id_col, F.explode_outer(keys).alias("key"))
    more = each.join(aliases, "key", "left").select(id_col, F.explode(F.array("key", "alias")).alias("key"))
    return more.groupBy(id_col).agg(F.array_sort(F.collect_set("key")).alias(keys))


def two_key_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], id_left: str, id_right: str) -> DataFrame:
    """(id_left, id_right) where any pair of columns is equal: equi-joins united, no theta join."""
    parts = [left.join(right, left[a] == right[b]).select(left[id_left], right[id_right]) for a, b in pairs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def localized(df: DataFrame, labels: DataFrame, pool: DataFrame, table: Column, sno: Column, language: str) -> DataFrame:
    """``df`` with ``localized``: (table, sno) to a pool id in the language, then to its payload; 0 and null give null."""
    l = labels.select(F.col("source_table").alias("__t"), F.col("sno").alias("__s"), F.col(f"pool_id_{language}").alias("__p"))
    p = pool.select(F.col("pool_id").alias("__i"), F.col("payload").alias("localized"))
    out = df.join(l, (table == F.col("__t")) & (F.nullif(sno, F.lit(0)) == F.col("__s")), "left").join(p, F.col("__p") == F.col("__i"), "left")
    return out.drop("__t", "__s", "__p", "__i")


#: Notes that say a speech is not the speaker's own; every other kind brings a judgment.
EXCLUDES = "non_self_speech"
JUDGMENT = "struct<activated_memory:array<string>,interpretation:string,decision:string,emotion:string,intention:string,action:string,evidence:array<string>>"


def apply_annotations(rows: DataFrame, notes: DataFrame, learn: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, excluded, problems): records with the judgment of their note, records that a note takes out, and notes that cannot stand.

    ``rows``: record_key, kind, table, episode, speech, context (all turns) and memory (the lines that
    may be named). ``notes``: record_key, annotation_kind, reason, evidence, evidence_key, judgment. A
    note that excludes needs evidence in the speech of its own record, or of the one that it names in the
    same episode; a judgment must be complete, its evidence stand in the context and its memory among the
    lines. Without ``learn`` judgments are left aside, but their notes count as used. Each note must have
    a record and each key one note: ``problems`` has (record_key, problem) of all that do not, and is
    empty where everything is consumed. A record whose note has a problem is kept as it is.
    """
    from weftline.operators.records import evidence_problem

    n = notes.select("record_key", "annotation_kind", "reason", "evidence", "evidence_key", F.col("judgment").cast(JUDGMENT).alias("note"))
    counts = n.groupBy("record_key").agg(F.count("*").alias("__n"))
    n = n.join(counts, "record_key")
    out_ = F.col("annotation_kind").eqNullSafe(F.lit(EXCLUDES))
    shown = evidence_problem(n.where(out_ & (F.col("__n") == 1)).select("record_key", "evidence_key", "evidence"), rows).select(F.col("record_key").alias("__k"), F.col("problem").alias("__shown"))
    source = rows.select(F.col("record_key").alias("__r"), "context", "memory")
    j = n.join(shown, F.col("record_key") == F.col("__k"), "left").join(source, F.col("record_key") == F.col("__r"), "left")
    said = lambda c: F.coalesce(F.col(f"note.{c}"), F.lit("")) != ""
    whole = said("interpretation") & said("decision") & said("emotion") & said("intention") & said("action") & F.col("note.activated_memory").isNotNull() & (F.size(F.coalesce("note.evidence", F.array().cast("array<string>"))) > 0)
    stands = F.forall(F.coalesce("note.evidence", F.array().cast("array<string>")), lambda e: F.contains(F.coalesce("context", F.lit("")), e))
    known = F.size(F.array_except(F.coalesce("note.activated_memory", F.array().cast("array<string>")), F.coalesce("memory", F.array().cast("array<string>")))) == 0
    judged = F.when(F.lit(learn), F.when(~F.coalesce(whole, F.lit(False)), "incomplete").when(~F.coalesce(stands, F.lit(False)), "not_in_context").when(~known, "unknown_memory"))
    problem = F.when(F.col("__n") > 1, "repeated").when(F.col("__r").isNull(), "no_record").when(out_, F.col("__shown")).otherwise(judged)
    j = j.select(F.col("record_key").alias("__k"), "annotation_kind", "reason", "note", problem.alias("problem"))
    problems = j.where("problem is not null").select(F.col("__k").alias("record_key"), "problem")
    good = j.where("problem is null").drop("problem")
    met = rows.join(good, F.col("record_key") == F.col("__k"), "left")
    gone = F.col("annotation_kind").eqNullSafe(F.lit(EXCLUDES))
    kept = met.where(~gone).select(*rows.columns, F.when(F.lit(learn), F.col("note")).alias("judgment"))
    excluded = met.where(gone).select("record_key", F.lit(EXCLUDES).alias("exclusion"), F.col("reason").alias("detail"), F.col("speech").alias("preview"))
    return kept, excluded, problems
