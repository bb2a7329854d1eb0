"""Every registered query against its SQL, over the smallest tables."""

import pytest

from millrace.plans import catalog

from .compare import same


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, sf_dir, duck, name):
    same(catalog.QUERIES[name](spark, sf_dir), duck, catalog.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def over(spark, duck, tmp_path, name, **tables):
    """A query against its SQL over tables of its own."""
    con = duck.cursor()
    for k, df in tables.items():
        df.write.parquet(f"{tmp_path}/{k}.parquet")
        con.execute(f"create temp view {k} as select * from read_parquet('{tmp_path}/{k}.parquet/*.parquet')")
    same(catalog.QUERIES[name](spark, str(tmp_path)), con, catalog.ORACLES[name])


def test_code_density_flag_at_its_boundary(spark, duck, tmp_path):
    texts = ["{" + "x" * 18, "{" + "x" * 19, "{" + "x" * 20, "{};" * 17 + "x" * 969, ";", "", None]
    over(spark, duck, tmp_path, "code_density_flag", pages=spark.createDataFrame(list(enumerate(texts)), "page_id long, html string"))


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
