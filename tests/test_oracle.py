"""Every registered query against its DuckDB oracle on the smallest tables
(order-insensitive, columns sorted by name, floats compared to 1e-9)."""

import math

import pandas as pd
import pytest

from tessera.plans import ORACLE_SQL, QUERIES, load_all

from .conftest import SF_SMALL

load_all()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return None if isinstance(v, float) and math.isnan(v) else round(float(v), 9)
    return v if isinstance(v, str) else str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "float": "FLOAT",
    "date": "DATE",
}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    # Column types agree with the oracle's (bound without running it).
    rel = duck.sql(ORACLE_SQL[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in sdf.schema.fields:
        st = f.dataType.simpleString()
        assert SPARK_TO_DUCK.get(st, st) == duck_types.get(f.name), (f.name, st, duck_types.get(f.name))
    got = sdf.toPandas()
    want = duck.execute(ORACLE_SQL[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
