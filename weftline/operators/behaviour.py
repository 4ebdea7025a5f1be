"""Label records: beside each record whose judgment is complete, one whose answer is the judgment itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.records import json_text

SPEECH, BEHAVIOUR = "persona_speech", "behavior_judgment"


def with_behaviour(records: DataFrame, fields: list[str], cue: str) -> DataFrame:
    """``records`` (id, task, prompt, completion, judgment, record_key) and, for each speech record with a complete judgment, a label record.

    A judgment (activated_memory and text ``fields``) is complete if its memory is not null and no field is empty. The label record has
    the id with ``:judgment``, the record's id as ``origin_id``, the memory's lines added to the system message (each line
    once, in order), the cue ahead of the last message, and compact JSON of the fields as its answer. Records without a
    prompt give none.
    """
    none = F.lit(None).cast("string")
    plain = records.withColumns({"origin_id": none, "evidence_key": none})
    whole = F.col("judgment.activated_memory").isNotNull() & (F.size("prompt") > 0)
    for f in fields:
        whole = whole & (F.coalesce(F.col(f"judgment.{f}"), F.lit("")) != "")
    system = F.array_join(F.array_distinct(F.concat(F.split(F.coalesce(F.col("prompt")[0]["content"], F.lit("")), "\r\n|\r|\n"), "judgment.activated_memory")), "\n")
    last = F.size("prompt")
    prompt = F.transform("prompt", lambda m, i: F.struct(m["role"].alias("role"), F.concat(F.when(i + 1 == last, F.lit(cue + "\n")).otherwise(""), F.when(i == 0, system).otherwise(m["content"])).alias("content")))
    answer = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{f}":'), json_text(F.col(f"judgment.{f}"))) for f in fields]), F.lit("}"))
    made = records.where((F.col("task") == SPEECH) & F.coalesce(whole, F.lit(False)))
    made = made.withColumns({
        "origin_id": F.col("id"), "evidence_key": F.concat(F.lit("record_key="), "record_key"), "prompt": prompt, "completion": F.array(F.struct(F.lit("assistant").alias("role"), answer.alias("content"))),
        "id": F.concat("id", F.lit(":judgment")), "task": F.lit(BEHAVIOUR),
    })
    return plain.unionByName(made)


def encoded(df: DataFrame, prompt_ids: str, ids: str, most: int, ignore: int = -100) -> DataFrame:
    """``df`` with ``labels`` and ``problem``: not_a_prefix (the prompt is not the beginning of the whole, or is all of it) or too_long.

    Labels are the ids with the prompt's places ignored; null where there is a problem. Null ids are empty.
    """
    none: Column = F.array().cast("array<int>")
    p, x = F.coalesce(F.col(prompt_ids).cast("array<int>"), none), F.coalesce(F.col(ids).cast("array<int>"), none)
    head = F.slice(x, F.lit(1), F.greatest(F.size(p), F.lit(1)))
    begins = (F.size(x) > F.size(p)) & ((F.size(p) == 0) | (head == p))
    problem = F.when(~begins, "not_a_prefix").when(F.size(x) > most, "too_long")
    labels = F.transform(x, lambda v, i: F.when(i < F.size(p), F.lit(ignore)).otherwise(v))
    return df.withColumn("problem", problem).withColumn("labels", F.when(F.col("problem").isNull(), labels))
