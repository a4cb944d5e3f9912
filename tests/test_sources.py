import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rebuy.sources.files import (nan_to_null, read_csv_table, read_feature_tables, write_csv,
                                 write_feature_tables)


def test_csv_empty_gap_is_null(spark):
    d = tempfile.mkdtemp(prefix="rebuy-csv-")
    p = os.path.join(d, "orders.csv")
    with open(p, "w") as f:
        f.write("order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n")
        f.write("1,7,prior,1,2,8,\n2,7,train,2,3,9,15.0\n")
    rows = {r.order_id: r for r in read_csv_table(spark, p, "orders").collect()}
    assert rows[1].days_since_prior_order is None
    assert rows[2].days_since_prior_order == 15.0 and rows[2].eval_set == "train"


def test_nan_becomes_null(spark):
    d = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r.x for r in nan_to_null(d).collect()] == [None, 1.0]


def test_feature_table_round_trip(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="rebuy-ft-"), "ft")
    a = spark.createDataFrame([(1, 2, 0.5)], "user_id long, product_id long, f double")
    b = spark.createDataFrame([(3, 4, 1.5)], "user_id long, product_id long, f double")
    write_feature_tables(a, b, path)
    tr, te = read_feature_tables(spark, path)
    assert tr.select("f").first().f == 0.5 and te.select("f").first().f == 1.5
    assert "split" not in tr.columns


CELLS = ["plain", 'two\nlines', '"quoted"', 'a,"b"\n\n,c', "\n", "x" * 30, 'ends with "', '","\n","', None, "é\n\n\nü"]


def test_line_breaks_over_many_splits(spark):
    """Records of several lines, cut into splits of a few bytes, come back whole."""
    path = os.path.join(tempfile.mkdtemp(prefix="rebuy-csv-"), "t")
    rows = [(i, CELLS[i % len(CELLS)], i / 4) for i in range(300)]
    write_csv(spark.createDataFrame(rows, "id int, cell string, v double").coalesce(2), path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        assert spark.read.text(path).rdd.getNumPartitions() > 20
        schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("cell", T.StringType()), T.StructField("v", T.DoubleType())])
        for got in (read_csv_table(spark, path, schema), read_csv_table(spark, path), read_csv_table(spark, path, schema, line_breaks=True)):
            assert sorted((r.id, r.cell, r.v) for r in got.collect()) == rows
        assert dict(read_csv_table(spark, path).dtypes) == {"id": "bigint", "cell": "string", "v": "double"}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_inferred_types_look_at_every_cell(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="rebuy-csv-"), "t.csv")
    with open(path, "w") as f:
        f.write("a,b,c,d,e\n" + "1,2,3.5,,x\n" * 50 + "2,-7.25,9999999999999999999,,1\n")
    df = read_csv_table(spark, path)
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "double", "d": "string", "e": "string"}
    assert df.count() == 51 and df.filter("d is not null").count() == 0


def test_malformed_cells_fail(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="rebuy-csv-"), "t.csv")
    with open(path, "w") as f:
        f.write('product_id,product_name,aisle_id,department_id\n1,"a\nb",x,3\n')
    with pytest.raises(Exception):
        read_csv_table(spark, path, "products").collect()


def _raw_folder(spark, path, custkeys):
    """Two orders a user; order 1 holds a product twice, order 9 has no line; keys repeat and are null."""
    part = [(1, "Brand#12", "STEEL"), (2, "Brand#11", "BRASS"), (3, "Brand#12", "STEEL"), (4, "Brand#13", "TIN")]
    orders = [(2 * i + j, u, f"2020-01-{1 + i + 5 * j:02d} 00:00:00") for i, u in enumerate(custkeys) for j in (1, 2)] + [(9, custkeys[0], "2020-02-01 00:00:00")]
    lines = [(1, 1, 2), (1, 3, 1), (1, 2, 3), (1, None, 4), (1, 77, 5), (None, 1, 1)] + [(o, p, n) for o in range(2, 2 * len(custkeys) + 1) for n, p in enumerate((2, 1), 1)]
    spark.createDataFrame(part, "p_partkey long, p_brand string, p_type string").write.parquet(f"{path}/part.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate string").withColumn(
        "o_orderdate", F.to_timestamp("o_orderdate")).write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(f"{path}/lineitem.parquet")
    return len(lines)


def test_basket_tables_derive_the_lines_once(spark, tmp_path, monkeypatch):
    from rebuy.sources import testdata as td
    n = _raw_folder(spark, str(tmp_path / "raw"), [4, 5])
    seen = spark.sparkContext.accumulator(0)

    def count(v):
        seen.add(1)
        return v
    plain = td._raw
    counted = F.udf(count, T.IntegerType()).asNondeterministic()
    monkeypatch.setattr(td, "_raw", lambda s, d, name: plain(s, d, name).withColumn("l_linenumber", counted("l_linenumber"))
                        if name == "lineitem" else plain(s, d, name))
    t = td.basket_tables(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert seen.value == n
    # types by name: BRASS 1, STEEL 2, TIN 3; product = aisle x 10 + department
    assert sorted(map(tuple, t.prior.collect())) == [(1, 111, 2, 0), (1, 122, 1, 0), (3, 111, 1, 0), (3, 122, 2, 0)]
    assert sorted(map(tuple, t.train.collect())) == [(2, 111, 1, 1), (2, 122, 2, 1), (4, 111, 1, 1), (4, 122, 2, 1)]
    assert sorted((r.order_id, r.user_id, r.eval_set, r.order_number, r.days_since_prior_order) for r in t.orders.collect()) == [
        (1, 4, "prior", 1, None), (2, 4, "train", 2, 5.0), (3, 5, "prior", 1, None), (4, 5, "train", 2, 5.0)]


def test_basket_tables_without_current_lines(spark, tmp_path):
    from rebuy.sources import testdata as td
    _raw_folder(spark, str(tmp_path / "raw"), [9])
    t = td.basket_tables(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert t.train.columns == t.prior.columns == ["order_id", "product_id", "add_to_cart_order", "reordered"]
    assert t.train.count() == 0 and t.prior.count() == 2


def test_basket_tables_store_an_order_once_with_its_basket(spark, tmp_path):
    """Lines meet their order as one row, not by a stored line table that is shuffled to the
    orders again; repeated lines, orders that come twice, orders without lines and null keys."""
    from rebuy.sources.testdata import basket_tables
    at = str(tmp_path / "in")
    spark.createDataFrame([(1, "Brand#11", "A"), (2, "Brand#11", "B"), (3, "Brand#12", "A")],
                          "p_partkey long, p_brand string, p_type string").write.parquet(f"{at}/part.parquet")
    spark.createDataFrame([(10, 2, 2), (10, 1, 3), (10, 1, 1), (11, 1, 1), (11, 3, 2), (12, 3, 1), (None, 1, 1), (13, None, 1)],
                          "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(10, 5, "2024-01-01"), (11, 5, "2024-01-05"), (12, 9, "2024-01-02"), (12, 9, "2024-01-02"),
                           (13, 5, "2024-02-01"), (14, 5, "2024-03-01"), (None, 5, "2024-03-01")],
                          "o_orderkey long, o_custkey long, o_orderdate string").write.parquet(f"{at}/orders.parquet")
    t = basket_tables(spark, at, str(tmp_path / "out"))
    assert "lines" not in os.listdir(tmp_path / "out")
    assert sorted(map(tuple, t.orders.select("order_id", "user_id", "eval_set", "order_number", "days_since_prior_order").collect()), key=str) == [
        (10, 5, "prior", 1, None), (11, 5, "train", 2, 4.0), (12, 9, "prior", 1, None), (12, 9, "test", 2, 0.0)]
    assert sorted(map(tuple, t.prior.collect())) == [(10, 111, 1, 0), (10, 112, 2, 0), (12, 121, 1, 0)]
    assert sorted(map(tuple, t.train.collect())) == [(11, 111, 1, 1), (11, 121, 2, 0)]
