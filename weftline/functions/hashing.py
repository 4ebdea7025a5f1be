"""Reproducible assignment by hash, and content keys."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_index(key: Column, n: int | Column) -> Column:
    """The first 8 bytes of SHA-256, big-endian and unsigned, modulo n."""
    head = F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (head % (F.lit(n) if isinstance(n, int) else n)).cast("long")


def permille(key: Column) -> Column:
    """The first 4 bytes of SHA-256, unsigned, modulo 1000."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") % 1000


def held_out_split(key: Column) -> Column:
    """One in a thousand to validation, one to test, the rest to train."""
    p = permille(key)
    return F.when(p == 0, "validation").when(p == 1, "test").otherwise("train")


def seeded_order(seed: int, key: Column) -> Column:
    """A value to sort by that stands for a seeded shuffle: reproducible and free of physical order."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), key.cast("string")), 256)


def record_key(*parts: Column) -> Column:
    """SHA-256 of the parts as JSON; a null part counts as absent."""
    return F.sha2(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])), 256)


def fingerprint(prompt_tokens: Column, ids: Column) -> Column:
    """SHA-256 of a token sequence and the length of its prompt."""
    return F.sha2(F.concat(F.lit("["), prompt_tokens.cast("string"), F.lit(",["), F.array_join(F.transform(ids, lambda x: x.cast("string")), ","), F.lit("]]")), 256)


def settings_signature(settings: dict, resources: set[str], files: dict[str, str], moves: list) -> str:
    """SHA-256 of a run's settings without those that only name resources, the hashes of its split files and its moved rows."""
    kept = {k: v for k, v in settings.items() if k not in resources}
    return hashlib.sha256(json.dumps([kept, files, moves], sort_keys=True).encode()).hexdigest()
