"""Every layout query with SQL returns the rows that DuckDB returns for it."""

import pandas as pd
import pytest

from pagewright.plans import catalogue


def canonical(df):
    def one(v):
        if pd.isna(v):
            return "~"
        return repr(round(float(v), 9)) if isinstance(v, float) else str(v)

    return sorted("|".join(map(one, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_rows_as_duckdb(spark, duck, sf_dir, name):
    got = catalogue.queries()[name](spark, sf_dir).toPandas()
    want = duck.sql(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_runs_without_sql(spark, sf_dir, name):
    assert catalogue.queries()[name](spark, sf_dir).limit(5).collect()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["page_id", "text", "n_blocks"]
