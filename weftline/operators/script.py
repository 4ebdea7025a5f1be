"""Exchanges of branching scripts, over every path through their choices.

A script is a row of stages; a stage is one way (plain lines) or several (the options of a block of
choices, each with the lines of its branch), after which the paths rejoin. An answer is a run of the
owner's lines, its context all that stands between it and the answer before. An answer lies within one
way, and a context reaches back through ways without an answer to the last way with one. So exchanges
come from joins of neighbours: contexts are carried over runs of ways without answers, by doubling;
every other exchange is found inside its way. No path is walked, and no join is as deep as a script is
long. What came before the previous exchange follows the first path in the order of options, which the
last stages decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import text as texts
from weftline.operators.sequence import CHOICE, NARRATION, PLAYER, SPEECH, script_stages
from weftline.plans.shared import materialize

PRESENT = "present"
KINDS = (SPEECH, CHOICE, PLAYER, NARRATION, PRESENT)
#: Exchanges before the previous one that an exchange knows.
EARLIER = 3

_NODE = ("group", "stage", "way", "i", "ctx")


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def unconverted(lines: DataFrame) -> DataFrame:
    """The lines that no rule takes: of another kind or without text."""
    return lines.where(~F.coalesce(F.col("kind").isin(*KINDS) & (F.col("text") != ""), F.lit(False)))


def context_item(gift: str) -> Column:
    """What a line that is not an answer adds to the context: brackets for what happens, the label of a gift, the name of another speaker."""
    bracket = F.concat(F.lit("("), F.col("text"), F.lit(")"))
    other = F.when(F.coalesce(F.col("speaker"), F.lit("")) != "", F.concat_ws(": ", "speaker", "text")).otherwise(bracket)
    return F.when(F.col("kind") == NARRATION, bracket).when(F.col("kind") == PRESENT, F.concat(F.lit(f"({gift}: "), F.col("text"), F.lit(")"))).when(F.col("kind") == PLAYER, F.col("text")).otherwise(other)


def _events(lines: DataFrame, own: str, by_group: bool, gift: str, white: str) -> DataFrame:
    """(group, stage, way, opt, idx, own, text, idxs, keys): the lines of every way; an option is one event ahead of its branch."""
    staged = materialize(script_stages(lines, "group", by_group), "stages")
    answers = (F.col("kind") == SPEECH) & F.col("speaker").eqNullSafe(F.lit(own))
    choices = staged.where((F.col("part") == "option") & (F.col("kind") == CHOICE))
    if by_group:
        said = F.when(texts.is_quoted(F.col("text")), texts.unquote(F.col("text"), white)).otherwise(F.concat(F.lit("("), F.col("text"), F.lit(")")))
        way = F.coalesce(F.col("choice_group"), F.lit(0)).cast("long")
    else:
        said, way = texts.unquote(F.col("text"), white), F.col("idx")
    parts = choices.groupBy("group", "stage", way.alias("way")).agg(F.array_sort(F.collect_list(F.struct("idx", said.alias("text"), "key"))).alias("p"))
    each = lambda name: F.transform("p", lambda x: x[name])
    options = parts.select("group", "stage", "way", F.element_at("p", 1)["idx"].alias("opt"), F.lit(-1).cast("long").alias("idx"), F.lit(False).alias("own"), F.array_join(each("text"), " ").alias("text"), each("idx").alias("idxs"), each("key").alias("keys"))
    ways = materialize(options, "options")

    line = staged.where("part <> 'option'").select("group", "stage", "part", F.when(F.col("part") == "branch", F.col("choice_group").cast("long")).otherwise(F.lit(0)).alias("way"), "idx", answers.alias("own"), F.when(answers, F.col("text")).otherwise(context_item(gift)).alias("text"), F.array("idx").alias("idxs"), F.array("key").alias("keys"))
    # Answers at the head of plain lines go on with those of any branch before them: each way of that stage gets them.
    w = Window.partitionBy("group", "stage").orderBy("idx")
    plain = line.where("part = 'plain'").withColumn("head", F.col("own") & (F.col("stage") > 1) & (F.sum(F.when(F.col("own"), 0).otherwise(1)).over(w) == 0))
    key = ways.select(F.col("group").alias("g"), F.col("stage").alias("s"), F.col("way").alias("y"), "opt")
    same = (F.col("group") == F.col("g")) & (F.col("stage") == F.col("s"))
    heads = plain.where("head").withColumn("stage", F.col("stage") - 1).join(key, same).withColumn("way", F.col("y"))
    branches = line.where("part = 'branch'").join(key, same & (F.col("way") == F.col("y")))
    out = ways.unionByName(plain.where("not head").withColumn("opt", F.lit(0).cast("long")).select(ways.columns))
    return out.unionByName(heads.select(ways.columns)).unionByName(branches.select(ways.columns))


def _blocks(events: DataFrame) -> DataFrame:
    """(group, stage, way, opt, i, items, ctx, keys, said, said_keys): each way as runs of context and the answer after each, stages numbered without gaps."""
    w = Window.partitionBy("group", "stage", "way").orderBy("idx")
    starts = ~F.col("own") & F.lag("own", 1, False).over(w)
    out = events.withColumn("__s", F.when(starts, 1).otherwise(0)).withColumn("i", F.sum("__s").over(w))
    rows = out.groupBy("group", "stage", "way", "opt", "i").agg(F.array_sort(F.collect_list(F.struct("idx", "own", "text", "idxs", "keys"))).alias("e"))
    pick = lambda own, name: F.transform(F.filter("e", lambda x: x["own"] == own), lambda x: x[name])
    rows = rows.select("group", "stage", "way", "opt", "i", pick(False, "text").alias("items"), F.flatten(pick(False, "idxs")).alias("ctx"), F.flatten(pick(False, "keys")).alias("keys"), pick(True, "text").alias("said"), F.flatten(pick(True, "keys")).alias("said_keys"))
    rows = rows.withColumn("said", F.when(F.size("said") > 0, F.array_join("said", " ")))
    return rows.withColumn("stage", F.dense_rank().over(Window.partitionBy("group").orderBy("stage")).cast("long"))


def _carried(blocks: DataFrame) -> DataFrame:
    """(group, stage, from_stage, from_way, from_i, items, ctx, keys, ord): what stands before a stage since the last answer, and which way had that."""
    ends = blocks.groupBy("group", "stage", "way", "opt").agg(F.max(F.when(F.col("said").isNotNull(), F.col("i"))).alias("from_i"), F.max(F.struct("i", "said", "items", "ctx", "keys")).alias("z"))
    ends = materialize(ends, "ends")
    opened = F.col("z.said").isNull()
    after = ends.where("from_i is not null").select(
        "group", (F.col("stage") + 1).alias("stage"), F.col("stage").alias("from_stage"), F.col("way").alias("from_way"), "from_i",
        F.when(opened, F.col("z.items")).otherwise(_none("string")).alias("items"), F.when(opened, F.col("z.ctx")).otherwise(_none("bigint")).alias("ctx"), F.when(opened, F.col("z.keys")).otherwise(_none("bigint")).alias("keys"), F.array("opt").alias("ord"),
    )
    none = F.lit(None).cast("long")
    start = ends.select("group").distinct().select("group", F.lit(1).cast("long").alias("stage"), none.alias("from_stage"), none.alias("from_way"), F.lit(None).cast(after.schema["from_i"].dataType).alias("from_i"), _none("string").alias("items"), _none("bigint").alias("ctx"), _none("bigint").alias("keys"), _none("bigint").alias("ord"))
    carried = materialize(after.unionByName(start), "carried")
    through = materialize(ends.where("from_i is null").select("group", "stage", (F.col("stage") + 1).alias("to"), F.col("z.items").alias("items"), F.col("z.ctx").alias("ctx"), F.col("z.keys").alias("keys"), F.array("opt").alias("ord")), "through")
    # The longest run of stages with a way without an answer bounds how far a context is carried.
    w = Window.partitionBy("group").orderBy("stage")
    runs = through.select("group", "stage").distinct().withColumn("r", F.col("stage") - F.row_number().over(w)).groupBy("group", "r").count()
    longest = int(runs.agg(F.coalesce(F.max("count"), F.lit(0))).first()[0])
    jumps = [through] if longest else []
    while 1 << len(jumps) <= longest:
        jumps.append(materialize(_joined(jumps[-1], jumps[-1], "to"), "through"))
    for jump in reversed(jumps):
        carried = materialize(carried.unionByName(_joined(carried, jump, "stage")), "carried")
    return carried


def _joined(left: DataFrame, right: DataFrame, at: str) -> DataFrame:
    """``left`` gone on by the ways of ``right`` that begin where it stands, at its column ``at``; the latest options come first in ``ord``."""
    far = right.select(F.col("group").alias("__g"), F.col("stage").alias("__s"), F.col("to").alias("__to"), *[F.col(c).alias(f"__{c}") for c in ("items", "ctx", "keys", "ord")])
    out = left.join(far, (F.col("group") == F.col("__g")) & (F.col(at) == F.col("__s"))).withColumn(at, F.col("__to"))
    for c in ("items", "ctx", "keys"):
        out = out.withColumn(c, F.concat(c, f"__{c}"))
    return out.withColumn("ord", F.concat("__ord", "ord")).select(*left.columns)


def walked(lines: DataFrame, own: str, key: str = "group_no", by_group: bool = True, gift: str = "gift", white: str = texts.WHITE) -> tuple[DataFrame, DataFrame]:
    """(exchanges, unanswered) of scripts: ``lines`` of (key, idx, kind, speaker, choice_group, text), idx unique in its script.

    Runs of speech by ``own`` are answers, all else is context. With ``by_group`` the choices of one
    group are one option, quoted ones without their quotes and others in brackets, and lines after the
    block that have a group are the branch of that option; else each choice is an option of its own
    without quotes and branch. ``white`` goes with the quotes, at both ends. ``exchanges``: key, user_items, keys (idx of context and answer),
    answer, previous, previous_items and earlier (up to three exchanges before the previous one, the
    oldest first), one row for each answer, items and previous exchange. ``unanswered``: key, items,
    keys, previous and previous_items where a path ends without an answer. Lines of unknown kind or
    without text, and those without a key, are left out.
    """
    kind = lines.schema[key].dataType
    src = lines.where(F.col(key).isNotNull() & F.col("kind").isin(*KINDS) & (F.col("text") != ""))
    src = src.select(F.col(key).alias("group"), F.col("idx").cast("long").alias("idx"), F.col("idx").cast("long").alias("key"), "kind", "speaker", F.coalesce("choice_group", F.lit(0)).alias("choice_group"), "text")
    blocks = materialize(_blocks(_events(src, own, by_group, gift, white)), "blocks")
    carried = _carried(blocks)

    put = carried.select(F.col("group").alias("__g"), F.col("stage").alias("__s"), "from_stage", "from_way", "from_i", *[F.col(c).alias(f"__{c}") for c in ("items", "ctx", "keys", "ord")])
    first = blocks.where("i = 0 and said is not null").join(put, (F.col("group") == F.col("__g")) & (F.col("stage") == F.col("__s")))
    for c in ("items", "ctx", "keys"):
        first = first.withColumn(c, F.concat(f"__{c}", c))
    first = materialize(first.withColumn("ord", F.concat(F.array("opt"), "__ord")).drop("__g", "__s", "__items", "__ctx", "__keys", "__ord"), "first")
    inner = blocks.where("i > 0 and said is not null").withColumn("ord", F.array("opt"))
    same = first.groupBy(*_NODE).agg(F.min_by(F.struct("opt", "items", "keys", "said", "said_keys"), "ord").alias("b"), F.min("ord").alias("ord"))
    nodes = materialize(same.select(*_NODE, "b.*", "ord").unionByName(inner.select(*_NODE, "opt", "items", "keys", "said", "said_keys", "ord")), "nodes")

    # (node, place of the previous answer): that of the same way, or the last of the way that the context came from.
    links = inner.select(*_NODE, F.col("stage").alias("p_stage"), F.col("way").alias("p_way"), (F.col("i") - 1).alias("p_i"))
    links = links.unionByName(first.where("from_stage is not null").select(*_NODE, F.col("from_stage").alias("p_stage"), F.col("from_way").alias("p_way"), F.col("from_i").alias("p_i")))
    past = nodes.select(F.col("group").alias("__g"), F.col("stage").alias("__s"), F.col("way").alias("__w"), F.col("i").alias("__i"), F.col("ctx").alias("p_ctx"), F.col("items").alias("p_items"), F.col("said").alias("p_said"), F.col("ord").alias("p_ord"))
    at = (F.col("group") == F.col("__g")) & (F.col("p_stage") == F.col("__s")) & (F.col("p_way") == F.col("__w")) & (F.col("p_i") == F.col("__i"))
    place = F.struct(F.col("p_stage").alias("stage"), F.col("p_way").alias("way"), F.col("p_i").alias("i"), F.col("p_ctx").alias("ctx"))
    pairs = materialize(links.join(past, at).select(*_NODE, place.alias("p"), "p_items", "p_said", "p_ord"), "pairs")
    # Before the previous exchange, the first path counts: one pointer a node.
    back = materialize(pairs.groupBy(*_NODE).agg(F.min_by(F.struct("p", "p_items", "p_said"), "p_ord").alias("b")), "back")
    node = F.struct("stage", "way", "i", "ctx")
    known = pairs.groupBy(*_NODE, "p_items", "p_said").agg(F.min_by("p", "p_ord").alias("p"), F.min("p_ord").alias("p_ord"))
    known = known.withColumn("earlier", _none("struct<user:array<string>,answer:string>")).withColumn("__at", F.col("p"))
    for _ in range(EARLIER):
        far = back.select(F.col("group").alias("__g"), node.alias("__n"), "b")
        known = known.join(far, (F.col("group") == F.col("__g")) & (F.col("__at") == F.col("__n")), "left")
        one = F.array(F.struct(F.col("b.p_items").alias("user"), F.col("b.p_said").alias("answer")))
        known = known.withColumn("earlier", F.when(F.col("b").isNull(), F.col("earlier")).otherwise(F.concat(one, "earlier"))).withColumn("__at", F.col("b.p")).drop("__g", "__n", "b")
    opening = first.where("from_stage is null").select(*_NODE).distinct()
    known = known.select(*_NODE, "p_items", "p_said", "p_ord", "earlier")
    empty = opening.select(*_NODE, _none("string").alias("p_items"), F.lit(None).cast("string").alias("p_said"), _none("bigint").alias("p_ord"), _none("struct<user:array<string>,answer:string>").alias("earlier"))
    full = nodes.join(known.unionByName(empty), list(_NODE))
    row = F.struct("keys", "earlier")
    out = full.groupBy("group", "items", "said", "said_keys", "p_items", "p_said").agg(F.min_by(row, F.struct("ord", "p_ord")).alias("r"))
    out = out.select(F.col("group").cast(kind).alias(key), F.col("items").alias("user_items"), F.concat("r.keys", "said_keys").alias("keys"), F.col("said").alias("answer"), F.col("p_said").alias("previous"), F.col("p_items").alias("previous_items"), F.col("r.earlier").alias("earlier"))

    last = blocks.groupBy(F.col("group").alias("__e")).agg((F.max("stage") + 1).alias("__last"))
    open_ = carried.join(last, (F.col("group") == F.col("__e")) & (F.col("stage") == F.col("__last"))).where(F.size("items") > 0)
    open_ = open_.withColumnsRenamed({"from_stage": "p_stage", "from_way": "p_way", "from_i": "p_i"}).select("group", "items", "keys", "p_stage", "p_way", "p_i")
    rest = open_.join(past, at, "left").select(F.col("group").cast(kind).alias(key), "items", "keys", F.col("p_said").alias("previous"), F.coalesce("p_items", _none("string")).alias("previous_items")).distinct()
    return out, rest
