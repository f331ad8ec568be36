import os

import duckdb
import pandas as pd

import __spark_entry__ as E
from conftest import SF_SMALL
from eventide.sources.tables import TABLES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "cnt"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_declared():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    # the text operators say in their own tests how they are held
    assert set(E.catalog.QUERIES) - set(s) == {"unique_visitors_hll"}


def _norm(df):
    df = df[sorted(df.columns)]
    return sorted(tuple("" if pd.isna(v) else str(v) for v in r) for r in df.itertuples(index=False))


def test_all_queries_match_oracle_small(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    sql = E.oracle_sql()
    for name, q in E.queries().items():
        if name not in E.catalog.QUERIES:
            continue
        sp = q(spark, SF_SMALL).toPandas()
        if name not in sql:
            assert len(sp) > 0
            continue
        dk = con.execute(sql[name]).fetchdf()
        assert sorted(sp.columns) == sorted(dk.columns), name
        assert len(sp) == len(dk), name
        assert _norm(sp) == _norm(dk.astype(sp.dtypes.to_dict())), name
