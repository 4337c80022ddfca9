"""Every key with an oracle must match DuckDB on the small tables: same
column names, same row count, same multiset of rows."""
import math

import pytest

import __spark_entry__ as E

KEYS = sorted(E.oracle_sql())


def _norm(v):
    import pandas as pd
    if isinstance(v, (list, tuple)) or getattr(v, "ndim", 0) > 0:
        return str([_norm(x) for x in v])
    if v is None or (not isinstance(v, str) and pd.isna(v)):
        return "<null>"
    if isinstance(v, float):
        return repr(round(v, 9)) if not math.isnan(v) else "<null>"
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, sf, duck, key):
    df = E.queries()[key](spark, sf)
    rel = duck.sql(E.oracle_sql()[key])
    assert {n: SPARK_TO_DUCK.get(t, t) for n, t in df.dtypes} == dict(zip(rel.columns, map(str, rel.types)))
    got = df.toPandas()
    want = rel.df()
    c1, r1 = _rows(got)
    c2, r2 = _rows(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
