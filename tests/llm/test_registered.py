import duckdb
import pytest

import __spark_entry__ as entry
from strider.llm.queries import ORACLE, QUERIES

BASE = "/root/testdata/sf0.01"


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(QUERIES) <= set(names) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{BASE}/{table}.parquet')")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, BASE)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.select(*columns).fetchall())


def test_staged_files_go_to_the_shared_folder(spark):
    from strider.llm.common import shared_dir, staged
    out = staged(spark.range(3).toDF("x"), "probe")
    assert shared_dir(spark).split(":")[-1] + "/probe-" in out.inputFiles()[0]
