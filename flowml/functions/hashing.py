"""Deterministic, partition-independent random draws.

A draw is the first 32 bits of ``md5("seed:part1:part2...")``. It depends only on
the row's key, never on partitioning or task order, so splits and samples are
reproducible after any repartition, retry or executor loss. The same expression
is portable to SQL engines that have ``md5`` (the oracle uses it).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _parts(parts) -> list[Column]:
    out = []
    for p in parts:
        c = p if isinstance(p, Column) else F.lit(str(p))
        out.append(c.cast("string"))
    return out


def hash_u32(seed, *parts) -> Column:
    """Unsigned 32-bit draw in [0, 2^32) as a long."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *_parts(parts)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_uniform(seed, *parts) -> Column:
    """Uniform draw in [0, 1)."""
    return hash_u32(seed, *parts).cast("double") / F.lit(TWO_POW_32)


def sql_hash_u32(seed, *parts: str) -> str:
    """The same draw as a DuckDB SQL expression (used by the oracle)."""
    args = ", ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"CAST(('0x' || substr(md5(concat_ws(':', {args})), 1, 8)) AS UBIGINT)"


def sql_hash_uniform(seed, *parts: str) -> str:
    return f"(CAST({sql_hash_u32(seed, *parts)} AS DOUBLE) / {TWO_POW_32})"
