"""Tables that follow files whose columns drift."""

import pytest
from helpers import rows
from pyspark.sql import types as T

from ridelake.session import fresh_path
from ridelake.sinks.catalog import Drift, crawl, evolve, retired_columns, wider
from ridelake.sinks.layers import write_partitioned

DAY = T.StructType([T.StructField("day", T.IntegerType())])


@pytest.mark.parametrize(
    "a, b, both",
    [
        ("int", "bigint", "bigint"), ("double", "smallint", "double"), ("float", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
        ("decimal(5,2)", "decimal(6,4)", "decimal(7,4)"), ("string", "string", "string"), ("bigint", "double", None), ("int", "string", None), ("float", "int", None),
    ],
)
def test_types_that_hold_both(spark, a, b, both):
    x, y = (T.StructType.fromDDL(f"c {t}")["c"].dataType for t in (a, b))
    want = both and T.StructType.fromDDL(f"c {both}")["c"].dataType
    assert wider(x, y) == wider(y, x) == want


def test_a_table_follows_its_files(spark):
    path, table = fresh_path(spark, "crawled"), "crawled_days"
    put = lambda text: write_partitioned(spark.sql(f"SELECT {text}"), path, ["day"])
    put("1 AS id, 'a' AS old, 1 AS day")
    assert crawl(spark, table, path, DAY) == Drift()
    put("5000000000L AS id, 1.5D AS more, 2 AS day")
    assert crawl(spark, table, path, DAY) == Drift(["more"], ["id: int to bigint"], ["old"])
    assert retired_columns(spark, table) == ["old"] and crawl(spark, table, path, DAY) == Drift()
    assert spark.table(table).columns == ["id", "old", "more", "day"]
    assert rows(spark.table(table)) == [(1, "a", None, 1), (5000000000, None, 1.5, 2)]
    # two new generations at once, one narrower than the table, one with the retired column again
    put("CAST(7 AS smallint) AS id, 'c' AS old, 3 AS day")
    put("8 AS id, CAST(2 AS float) AS more, 4 AS day")
    assert crawl(spark, table, path, DAY) == Drift(restored=["old"])
    assert rows(spark.table(table), "id", "old", "more") == [(1, "a", None), (5000000000, None, 1.5), (7, "c", None), (8, None, 2.0)]
    # what cannot be widened leaves the table as it was
    put("'x' AS id, 5 AS day")
    with pytest.raises(ValueError, match="id: bigint is not string"):
        crawl(spark, table, path, DAY)
    assert spark.table(table).count() == 4 and spark.table(table).schema["id"].dataType == T.LongType()
    spark.sql(f"DROP TABLE {table}")


def test_a_widening_that_was_cut_off_is_finished(spark, monkeypatch):
    path, table = fresh_path(spark, "cut"), "cut_off"
    spark.sql("SELECT 1 AS id, 'a' AS old").write.parquet(path)
    evolve(spark, table, path, T.StructType.fromDDL("id int, old string"))
    evolve(spark, table, path, T.StructType.fromDDL("id int"))
    real = type(spark).sql

    def dies(self, text, *more):
        if "RENAME" in text:
            raise OSError("stopped")
        return real(self, text, *more)

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(type(spark), "sql", dies)
        evolve(spark, table, path, T.StructType.fromDDL("id bigint"))
    assert evolve(spark, table, path, T.StructType.fromDDL("id bigint")) == Drift()
    assert rows(spark.table(table)) == [(1, "a")] and retired_columns(spark, table) == ["old"]
    spark.sql(f"DROP TABLE {table}")
