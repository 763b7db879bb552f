"""Rounding by the exact binary value, half to even, as IEEE-minded callers expect.

``F.round`` rounds the shortest decimal form instead (0.285 gives 0.29, though the number
is below 0.285). The product with a power of ten is taken without error by splitting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2^27 + 1


def exact_round(x: Column, digits: int) -> Column:
    scale = 10.0**digits
    high = x * _SPLIT - (x * _SPLIT - x)
    product = x * scale
    error = (high * scale - product) + (x - high) * scale
    whole = F.floor(product).cast("double")
    over = (product - whole - 0.5) + error
    up = (over > 0) | ((over == 0) & (F.pmod(whole, F.lit(2.0)) == 1))
    return F.when(up, whole + 1).otherwise(whole) / scale


def exact_round_sql(x: str, digits: int) -> str:
    """The same in SQL."""
    s, k = f"{10.0**digits:.1f}", f"{_SPLIT:.1f}"
    return f"""(select case when o > 0 or (o = 0 and w % 2 = 1) then w + 1 else w end / {s} from (select w, (p - w - 0.5) + e as o
        from (select p, floor(p) as w, (h * {s} - p) + (v - h) * {s} as e from (select v, v * cast({s} as double) as p, v * cast({k} as double) - (v * cast({k} as double) - v) as h from (select cast({x} as double) as v)))))"""
