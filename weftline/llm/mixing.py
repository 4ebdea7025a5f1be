"""Mixing sources to target weights, with DataFrame functions alone.

The words of a source, in the order of its documents, form one stream that is cut into blocks of a
fixed length. The output is a row of shards of equal slots. Each slot draws its source, so a shard's
counts are multinomial; draws beyond a source's quota move to sources that fell short. The j-th slot
of a source takes the block at position j of a pseudorandom permutation of its blocks (a new one each
time round), and a join by block index gives the words to their documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.plans.shared import join_checked, materialize, running_total

#: A maximal run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Cells of a source in which its documents are numbered, so that no task sorts a whole source.
BUCKETS = 1024
#: Cells of the unit interval by which draws meet sources.
CELLS = 4096
#: Rows of (id, count) up to which they are broadcast: about 16 MB.
NARROW_ROWS = 1_000_000
#: Rounds of the swap-or-not permutation.
ROUNDS = 16
#: Cells by size in a source: so many classes a doubling of the size, and parts of a class by key.
SIZE_CLASSES, SIZE_PARTS = 4, 16
#: Units of one whole copy in running totals of fractions.
UNIT = 1 << 24


@dataclass
class Mix:
    """sized: doc_key, doc_id, source, size; sources: one row each; slots: one row an output block; taken: words by document with any."""

    sized: DataFrame
    sources: DataFrame
    slots: DataFrame
    taken: DataFrame


def source_targets(sizes: DataFrame, most: float = 3.0, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """(source, rank, source_size, target) from (source, source_size), one row a source.

    In code-point order, null last, sources weigh ``weights`` in turn and share the sum of all sizes.
    A target stops at ``most`` times its source's size and the rest is shared anew. That is the level
    at which sum(min(weight * level, most * size)) is the sum of all sizes: in the order of
    most * size / weight, a source is full if its ratio is below the level of those from it on.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    s = sizes.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.lit(most) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("ratio", "rank").rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    s = s.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    s = s.withColumn("level", F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(everything))
    share = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * F.col("level")))
    return s.select("source", "rank", "source_size", share.alias("target"))


def word_count(text_col: str):
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")


def permuted(x, n, key, seed: int, rounds: int = ROUNDS):
    """Position ``x`` of a pseudorandom permutation of 0..n-1 chosen by ``key`` (swap-or-not: any n, no table)."""

    def step(at, r):
        other = F.pmod(F.pmod(F.xxhash64(F.lit(seed), key, r, F.lit("k")), n) - at, n)
        swap = F.xxhash64(F.lit(seed), key, r, F.greatest(at, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), x, step)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = 128, shard_slots: int = 4096, seed: int = 7, most: int = 3) -> Mix:
    """Plan a mix of all ``docs``; see ``Mix`` for what comes back.

    A null or empty text has size 0 and is taken 0 times; a null source is a source of its own, last in
    order. Rows that repeat an id are documents of their own with separate words. No word is taken more
    than ``most`` times: a source with target T of S words is taken floor(T / S) times whole, and the
    rest is a prefix of its next permutation, whose last block is cut to end at T (one block off where
    that prefix holds the source's short last block). An empty table gives empty frames.
    """
    size = word_count(text_col)
    key = F.xxhash64(F.col(id_col), F.col(source_col), size)
    sized = materialize(docs.select(key.alias("doc_key"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size")), "sized")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = source_targets(sizes, float(most))
    src = src.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    # a hair under the whole, lest rounding of a full target starts one more turn
    turns = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0).cast("long")
    src = src.withColumn("turns", F.least(turns, F.lit(most).cast("long")))
    left = F.greatest(F.round(F.col("target") - F.col("turns") * F.col("source_size")).cast("long"), F.lit(0).cast("long"))
    src = src.withColumn("rest", F.when(F.col("turns") < most, left).otherwise(F.lit(0).cast("long")))
    src = src.withColumn("quota", F.col("turns") * F.col("blocks") + F.ceil(F.col("rest") / block).cast("long"))
    src = materialize(src, "sources")
    n_slots = src.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]

    slots = materialize(_drawn(src, n_slots, shard_slots, seed), "slots")
    slots = slots.join(src.select("rank", "blocks", "turns", "rest", "source_size"), "rank")
    slots = slots.withColumn("turn", F.floor(F.col("j") / F.col("blocks")).cast("long"))
    index = permuted(F.col("j") % F.col("blocks"), F.col("blocks"), F.struct("rank", "turn"), seed)
    last = (F.col("turn") == F.col("turns")) & (F.col("j") - F.col("turns") * F.col("blocks") + 1 == F.ceil(F.col("rest") / block))
    cut = F.when(last, (F.col("rest") - 1) % block + 1).otherwise(F.lit(block))
    slots = slots.withColumn("block", index).withColumn("words", F.least(cut, F.col("source_size") - F.col("block") * block).cast("long"))
    slots = slots.select("slot", F.floor(F.col("slot") / shard_slots).cast("long").alias("shard"), "rank", "turn", "block", "words")

    placed = sized.where("size > 0").join(src.select(F.col("source").alias("__s"), "rank"), F.col("source").eqNullSafe(F.col("__s")))
    placed = running_total(placed.drop("__s", "source"), "rank", F.pmod("doc_key", F.lit(BUCKETS)), ["doc_key", "doc_id"], F.col("size"), "first")
    final = F.floor((F.col("first") + F.col("size") - 1) / block)
    spans = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / block), final)))
    uses = slots.groupBy("rank", "block", "words").agg(F.count("*").alias("times"))
    at = F.col("block") * block
    overlap = F.greatest(F.least(F.col("first") + F.col("size"), at + F.col("words")) - F.greatest(F.col("first"), at), F.lit(0))
    taken = spans.join(uses, ["rank", "block"], "left").groupBy("doc_id", "rank", "first", "size").agg(F.coalesce(F.sum(overlap * F.col("times")), F.lit(0)).cast("long").alias("taken"))
    return Mix(sized, src, slots, taken)


def _drawn(src: DataFrame, n_slots: int, shard_slots: int, seed: int) -> DataFrame:
    """(slot, rank, j): the source of each output slot and which of that source's slots it is."""
    spark = src.sparkSession
    order = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    low = F.coalesce(F.sum("quota").over(order), F.lit(0))
    bounds = src.where("quota > 0").select("rank", "quota", low.alias("low"))
    per = max(1, -(-n_slots // CELLS))
    cells = bounds.select("rank", "low", (F.col("low") + F.col("quota")).alias("high"), F.explode(F.sequence(F.floor(F.col("low") / per), F.floor((F.col("low") + F.col("quota") - 1) / per))).alias("cell"))
    cells = materialize(cells, "bounds")
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("id"), F.lit("draw")), F.lit(max(1, n_slots)))
    draws = spark.range(n_slots).select(F.col("id").alias("slot"), draw.alias("draw"), F.floor(draw / per).alias("cell"))
    draws = draws.join(cells, "cell").where((F.col("draw") >= F.col("low")) & (F.col("draw") < F.col("high")))
    draws = materialize(draws.select("slot", "rank"), "draws")
    draws = running_total(draws, "rank", F.floor(F.col("slot") / shard_slots).cast("long"), ["slot"], F.lit(1), "j")
    draws = materialize(draws.join(src.select("rank", "quota"), "rank"), "numbered")
    fits = draws.where("j < quota").select("slot", "rank", "j")
    # what was drawn too often for one source goes, in order, to those drawn too seldom
    over = draws.where("j >= quota").select("slot", F.lit(0).alias("one"))
    over = running_total(over, "one", F.floor(F.col("slot") / shard_slots).cast("long"), ["slot"], F.lit(1), "o").select("slot", "o")
    got = draws.groupBy("rank").agg(F.count("*").alias("got"))
    short = src.where("quota > 0").select("rank", "quota").join(got, "rank", "left").fillna(0, ["got"]).where("got < quota")
    short = short.withColumn("o0", F.coalesce(F.sum(F.col("quota") - F.col("got")).over(order), F.lit(0)))
    short = short.select("rank", "o0", "got", F.explode(F.sequence(F.col("got"), F.col("quota") - 1)).alias("j"))
    short = short.select("rank", "j", (F.col("o0") + F.col("j") - F.col("got")).alias("o"))
    return fits.unionByName(over.join(short, "o").select("slot", "rank", "j"))


def taken_words(docs: DataFrame, **kw) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken."""
    m = mix(docs, **kw)
    src = m.sources.select(F.col("source").alias("__s"), F.col("rank").alias("__r"), "source_size", "target")
    out = m.taken.join(src, F.col("rank") == F.col("__r"))
    none = m.sized.where("size = 0").join(src, F.col("source").eqNullSafe(F.col("__s"))).withColumn("taken", F.lit(0).cast("long"))
    names = ["doc_id", "size", "source_size", "target", "taken"]
    return out.select(*names).unionByName(none.select(*names))


def whole_copies(taken: DataFrame, seed: int) -> DataFrame:
    """(doc_key, times) from (doc_key, rank, size, taken), one row a key.

    A document of s words of which t are taken comes floor(t / s) times, and once more with a
    probability of the fraction left. The fractions of a source are added up in the order of size, and
    a document is taken where the running total passes a whole number (from a start drawn for the
    source). So every document has its own share whatever its length, each stretch of sizes gets its
    due number of documents to within one, and the words of a source meet those taken to within about
    its largest document.
    """
    whole = F.floor(F.col("taken") / F.col("size"))
    part = F.round((F.col("taken") - whole * F.col("size")) * F.lit(float(UNIT)) / F.col("size")).cast("long")
    t = materialize(taken.select("doc_key", "rank", "size", whole.cast("int").alias("whole"), part.alias("part")), "shares")
    cell = F.floor(F.log2(F.col("size")) * SIZE_CLASSES).cast("int") * SIZE_PARTS + F.pmod("doc_key", F.lit(SIZE_PARTS)).cast("int")
    t = running_total(t, "rank", cell, ["size", "doc_key"], F.col("part"), "before")
    start = F.col("before") + F.pmod(F.xxhash64(F.lit(seed), F.col("rank"), F.lit("start")), F.lit(UNIT))
    more = F.floor((start + F.col("part")) / UNIT) - F.floor(start / UNIT)
    return t.select("doc_key", (F.col("whole") + more).cast("int").alias("times"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, **kw) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as the mix takes it whole (0 to 3 times; see ``whole_copies``).

    One without words stays once, for it weighs nothing in any mix. Rows of one id, source and size
    share one verdict.
    """
    m = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed, **kw)
    t = m.taken.join(m.sources.select("rank", "source"), "rank")
    t = t.withColumn("doc_key", F.xxhash64(F.col("doc_id"), F.col("source"), F.col("size")))
    t = whole_copies(t.groupBy("doc_key", "rank").agg(F.sum("size").alias("size"), F.sum("taken").alias("taken")), seed).where("times > 0")
    none = m.sized.where("size = 0").select("doc_key", F.lit(1).alias("times")).distinct()
    t = materialize(t.unionByName(none).select(F.col("doc_key").alias("__key"), F.col("times").alias("__times")), "times")
    # (key, count) rows are narrow: up to NARROW_ROWS of them are broadcast, so that texts stay where they are
    keyed = docs.withColumn("__key", F.xxhash64(F.col(id_col), F.col(source_col), word_count(text_col)))
    out = join_checked(keyed, t, "__key", "inner", NARROW_ROWS)
    return out.withColumn("__times", F.explode(F.array_repeat(F.lit(1), F.col("__times")))).select(*docs.columns)
