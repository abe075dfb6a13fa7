"""The registered queries: names, SQL for those that have it, use of the session's folder."""

import os
import re

import pytest

import __spark_entry__ as contract
from couchlog.llm import common
from couchlog.llm.queries import ORACLE, QUERIES
from tests.compare import connect, duck_rows, spark_rows
from tests.llm.tables import odd_rows, write

SF_DIR = "/root/testdata/sf0.001"


def test_fourteen_queries():
    names = [name for name in contract.queries() if re.match(r"op\d+_|pipeline$", name)]
    assert sorted(names) == sorted([*QUERIES, "pipeline"]) and len(names) == 14
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES} == set(range(1, 14))
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    wanted_columns, wanted = duck_rows(connect(SF_DIR), ORACLE[name])
    assert columns == wanted_columns and rows == wanted and len(rows) > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_on_odd_rows(spark, tmp_path, name):
    """Compared through one file, which is how the driver registers tables."""
    folder = write(spark, tmp_path / "sf", odd_rows(3, n=30))
    columns, rows = spark_rows(QUERIES[name](spark, folder))
    spark.read.parquet(f"{folder}/documents.parquet").toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    wanted_columns, wanted = duck_rows(connect(tmp_path), ORACLE[name])
    assert columns == wanted_columns and rows == wanted


def test_staged_tables_lie_in_the_named_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    df = common.stage(spark.range(3))
    assert all(name.removeprefix("file://").startswith(shared) for name in df.inputFiles())
    common.drop_staged(df)
    assert not os.path.exists(os.path.dirname(df.inputFiles()[0].removeprefix("file://")))
