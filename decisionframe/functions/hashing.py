"""Deterministic hashes that other SQL engines can reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def h60(text: Column) -> Column:
    """The first 60 bits of md5 as a long."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def keyed(*parts: Column | str) -> Column:
    """h60 of the parts joined by colons; strings are literals."""
    return h60(F.concat_ws(":", *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts)))


def u01(*parts: Column | str) -> Column:
    """Uniform in [0, 1) in steps of 1e-5."""
    return (keyed(*parts) % 100000) / F.lit(100000.0)


def pick(values: list[str | Column], *parts: Column | str) -> Column:
    """One of values, by the hash of the parts."""
    if len(values) == 1:
        return F.lit(values[0])
    return F.element_at(F.array(*map(F.lit, values)), (keyed(*parts) % len(values) + 1).cast("int"))


def sha256(c: Column) -> Column:
    """Sixty-four lower-case hexadecimal digits."""
    return F.sha2(c.cast("string"), 256)
