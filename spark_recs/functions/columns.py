"""Reusable column expressions.  Everything here is a built-in Catalyst
expression, so it stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_item(mbid: str = "recording_mbid", msid: str = "recording_msid") -> Column:
    """Canonical item id: the recording mbid, falling back to the msid."""
    return F.coalesce(F.col(mbid), F.col(msid))


def day(ts: str = "timestamp") -> Column:
    return F.to_date(F.col(ts))


def hash_key(seed: int, cols: Sequence[str]) -> Column:
    """md5 hex of ``seed|c1|c2|...`` — a seeded, partition-independent
    random key (dates render as yyyy-MM-dd).  Unlike ``rand(seed)`` it does
    not depend on how rows are spread over partitions."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def hash_unit(seed: int, cols: Sequence[str], buckets: int = 10_000) -> Column:
    """Seeded hash bucket in [0, buckets) from the first 8 hex digits of md5."""
    h = F.conv(F.substring(hash_key(seed, cols), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(buckets))


def split_is_train(rn: str = "row_number", n: str = "count", pct: int = 80) -> Column:
    """``row_number <= count * pct / 100`` in exact integer arithmetic."""
    return F.col(rn) * 100 <= F.col(n) * pct


def split_is_val(rn: str = "row_number", n: str = "count", pct: int = 80) -> Column:
    return F.col(rn) * 100 > F.col(n) * pct


def dot(a: Column, b: Column) -> Column:
    """Inner product of two numeric arrays as a left fold in double precision
    (higher-order functions, no Python)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda acc, x: acc + x)
