"""Every query equals its SQL on the smallest tables."""

import math

import pandas as pd
import pytest

from accordion.plans import registry
from conftest import SMALL

SQL = registry.oracle_sql()


def plain(frame: pd.DataFrame) -> list:
    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        try:
            return f"{float(v):.6f}" if not isinstance(v, str) else v
        except (TypeError, ValueError):
            return str(v)

    names = sorted(frame.columns)
    return sorted((tuple(one(v) for v in row) for row in frame[names].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    found = registry.queries()[name](spark, SMALL).toPandas()
    if name not in SQL:
        assert len(found) > 0
        return
    wanted = duck.sql(SQL[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert plain(found) == plain(wanted)
