"""Turns with quotes within quotes: glosses, the speaker ahead, and quoted, acted and plain parts."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.text import strip

# The quotes, and what stands for a note, a gloss behind or ahead of a word, a speaker, and a part of a turn.
OPEN, CLOSE = "「", "」"
NOTE = r"\s*[(（]※[^()（）]*[)）]"
GLOSS_BEHIND = r"(?<=[가-힣])[(（][^()（）「」]{1,4}[)）](?![가-힣])"
GLOSS_AHEAD = r"[(（]([^()（）「」]{1,4})[)）](?=[가-힣])"
SPEAKER = r"^\s*([^「」()（）\n]{1,24}?)\s*(?=[「(（])"
PART = r"「[^」]*(?:」|$)|[(（][^)）]*[)）]|[^「(（]+"
INNER = r"[(（][^)）]*[)）]|[^(（]+"


def outer_quotes(column: pa.Array) -> pa.Array:
    """Without the quotes inside quotes; a closing quote that nothing opened stays. Depths are prefix sums over the column's UTF-8 buffer."""
    column = column.cast(pa.large_string())
    if not len(column):
        return column
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if len(raw) < 3:
        return column
    a, b = OPEN.encode(), CLOSE.encode()  # three bytes each, alike but for the last
    head = (raw[:-2] == a[0]) & (raw[1:-1] == a[1])
    place = np.flatnonzero(head & ((raw[2:] == a[2]) | (raw[2:] == b[2])))
    opens = raw[place + 2] == a[2]
    row = np.searchsorted(offsets, place, "right") - 1
    # A closing quote without an open one counts for nothing: the depth is the sum less its least value so far,
    # in each text of its own; a step down between texts, greater than any depth, keeps them apart.
    step = np.where(opens, 1, -1)
    total = np.cumsum(step)
    starts = np.searchsorted(row, row, "left")
    own = total - (total[starts] - step[starts])
    base = own - row * (2 * len(place) + 2)
    least = np.minimum(np.minimum.accumulate(base) + row * (2 * len(place) + 2), 0)
    depth = own - least
    before = np.where(opens, depth - 1, depth + 1)
    unopened = ~opens & (least < np.where(starts == np.arange(len(place)), 0, np.concatenate(([0], least[:-1]))))
    drop = np.where(opens, before > 0, depth > 0) & ~unopened
    gone = np.zeros(len(raw), bool)
    for k in range(3):
        gone[place[drop] + k] = True
    left = np.concatenate(([0], np.cumsum(~gone)))[offsets]
    valid = None if not column.null_count else pa.array(np.asarray(column.is_valid())).buffers()[1]
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(left.astype(np.int64).tobytes()), pa.py_buffer(raw[~gone].tobytes()), valid, column.null_count)


def without_inner_quotes(c: Column) -> Column:
    """``outer_quotes`` of a text column."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return outer_quotes(pa.array(s, pa.large_string(), from_pandas=True)).to_pandas()

    return run(c)


def unglossed(c: Column) -> Column:
    """Without notes and glosses behind words, glosses ahead of words without their brackets, and no quotes inside quotes."""
    return without_inner_quotes(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, NOTE, ""), GLOSS_BEHIND, ""), GLOSS_AHEAD, "$1"))


def speaker_ahead(plain: Column) -> Column:
    """The name ahead of the first quote or bracket of an unglossed turn; null without one."""
    found = strip(F.regexp_extract(plain, SPEAKER, 1))
    return F.when(found != "", found)


def turn_parts(c: Column, known: list[str] | None = None) -> tuple[Column, Column]:
    """(speaker, parts) of a turn; parts are (kind, text): speech in quotes, action in brackets.

    Only a known speaker is taken off, where ``known`` is given. Brackets within a quote are actions too.
    What stands outside both is action if the turn has a quote, else speech. Empty parts are left out;
    the unglossed text should be a column of its own, for it is used several times.
    """
    name = speaker_ahead(c)
    name = name if known is None else F.when(name.isin(*known), name)
    body = F.when(name.isNotNull(), F.regexp_replace(c, SPEAKER, "")).otherwise(c)
    acted = lambda p: p.rlike("^[(（]")
    bare = lambda p: strip(F.regexp_replace(p, "^[(（]|[)）]$", ""))
    part = lambda kind, text: F.struct(kind.alias("kind"), text.alias("text"))

    def one(p: Column, narrated: Column) -> Column:
        inner = F.regexp_extract_all(F.regexp_replace(p, f"^{OPEN}|{CLOSE}$", ""), F.lit(INNER), F.lit(0))
        quoted = F.transform(inner, lambda q: part(F.when(acted(q), "action").otherwise("speech"), F.when(acted(q), bare(q)).otherwise(strip(q))))
        other = part(F.when(acted(p) | narrated, "action").otherwise("speech"), F.when(acted(p), bare(p)).otherwise(strip(p)))
        return F.when(p.startswith(OPEN), quoted).otherwise(F.array(other))

    # One element: what is known of the whole turn is computed once, not for each part.
    whole = F.array(F.struct(F.regexp_extract_all(body, F.lit(PART), F.lit(0)).alias("parts"), F.contains(c, F.lit(OPEN)).alias("narrated")))
    found = F.flatten(F.flatten(F.transform(whole, lambda t: F.transform(t["parts"], lambda p: one(p, t["narrated"])))))
    return name, F.filter(found, lambda x: x["text"] != "")
