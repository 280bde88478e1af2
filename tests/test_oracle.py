"""Every registered query against its DuckDB oracle on sf0.001 (row count,
column names, order-insensitive values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def canon(df):
    cols = sorted(df.columns)

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 9))
        if hasattr(v, "__len__") and not isinstance(v, (str, bytes)):
            return "[" + ", ".join(norm(x) for x in (v.tolist() if hasattr(v, "tolist") else v)) + "]"
        return repr(v)

    return cols, sorted("|".join(norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[key]).df()
    assert len(got) == len(exp)
    assert canon(got) == canon(exp)


@pytest.mark.parametrize("key", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, key):
    df = E.queries()[key](spark, SF)
    assert df.count() > 0 and len(df.columns) > 0


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["product_id_left", "product_id_right", "product_name_left", "product_name_right",
                          "cosine_similarity", "rank"]
    assert E.entry(spark).schema == df.schema
