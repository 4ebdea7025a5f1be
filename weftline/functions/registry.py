"""Functions by name: column builders that plans and settings can refer to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import hashing, text

#: Builders take a column and further arguments.
FUNCTIONS: dict[str, Callable[..., Column]] = {}


def register(name: str, build: Callable[..., Column]) -> None:
    """Add a builder; a name that is taken is an error."""
    if name in FUNCTIONS:
        raise ValueError(f"there is a function {name!r} already")
    FUNCTIONS[name] = build


for _name in ("normalize_text", "is_empty_text", "collapse_space", "clean_script_text", "is_quoted", "unquote", "slug", "join_cjk", "clean_roleplay", "sentences", "speech_level", "segments", "final_consonant", "with_particle", "word_stem", "preview", "call_name", "collapse_slots", "corrected", "section_after", "name_forms"):
    register(_name, getattr(text, _name))
for _name in ("stable_index", "permille", "held_out_split"):
    register(_name, getattr(hashing, _name))


def applied(df: DataFrame, specs: dict[str, tuple]) -> DataFrame:
    """``df`` with a column for each (function, column, arguments...); unknown functions are an error before anything runs."""
    unknown = sorted({s[0] for s in specs.values()} - set(FUNCTIONS))
    if unknown:
        raise KeyError(f"unknown functions {unknown}; there are {sorted(FUNCTIONS)}")
    return df.select("*", *[FUNCTIONS[f](F.col(c), *args).alias(name) for name, (f, c, *args) in specs.items()])
