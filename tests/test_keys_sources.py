import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from incidentmart.operators.enrich import assert_many_to_one, left_enrich
from incidentmart.operators.keys import assign_dense_keys, distinct_projections
from incidentmart.sources.csv import read_csv


def test_dense_keys_independent_of_partitioning(spark):
    rows = [(f"k{i % 97:03d}", i % 13) for i in range(3000)]
    df = spark.createDataFrame(rows, "a string, b int").repartition(7)
    expected = (df.distinct().withColumn("key", F.row_number().over(Window.orderBy("a", "b")))
                .orderBy("key").collect())
    for n in (1, 8, None):
        got = assign_dense_keys(df, ["a", "b"], "key", num_partitions=n).orderBy("key").collect()
        assert [tuple(r) for r in got] == [(r.key, r.a, r.b) for r in expected]


def test_distinct_projections_one_scan(spark):
    df = spark.createDataFrame([(1, "x", None), (1, "y", "p"), (2, "x", "p")],
                               "a int, b string, c string")
    sets = distinct_projections(df, {"ab": ["a", "b"], "c": ["c"]})
    assert sorted(tuple(r) for r in sets["ab"].collect()) == [(1, "x"), (1, "y"), (2, "x")]
    assert sorted(sets["c"].collect(), key=str) == sorted([(None,), ("p",)], key=str)


def test_null_key_matches_catalog_null_row(spark):
    fact = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "id int, k int")
    cat = spark.createDataFrame([(None, "unknown"), (5, "five")], "k int, label string")
    out = {r.id: r.label for r in left_enrich(fact, cat, ["k"], ["label"]).collect()}
    assert out == {1: "unknown", 2: "five", 3: None}


def test_duplicate_catalog_key_rejected(spark):
    cat = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError, match="not unique"):
        assert_many_to_one(cat, ["k"], "tc_entidad")


def test_csv_header_noise_and_missing_file(spark, workdir):
    p = os.path.join(workdir, "x.csv")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write(" ID_Entidad ,Nom\n1,Ñuñoa\n")
    df = read_csv(spark, workdir, "x.csv")
    assert df.columns == ["id_entidad", "nom"]
    assert df.first().nom == "Ñuñoa"
    with pytest.raises(FileNotFoundError, match="nope.csv"):
        read_csv(spark, workdir, "nope.csv")


def test_csv_header_with_byte_order_mark(spark, workdir):
    p = os.path.join(workdir, "bom.csv")
    with open(p, "w", encoding="utf-8-sig") as fh:
        fh.write("ID_Entidad,nom\n7,x\n")
    df = read_csv(spark, workdir, "bom.csv")
    assert df.columns == ["id_entidad", "nom"] and df.first().id_entidad == "7"


def test_file_row_number_across_splits(spark, workdir):
    p = os.path.join(workdir, "big.csv")
    n = 60000
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("v,pad\n")
        for i in range(n):
            fh.write(f"{i},{'x' * 20}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_csv(spark, workdir, "big.csv", row_id="rid")
        assert df.rdd.getNumPartitions() > 5
        bad = df.filter(F.col("rid") != F.col("v").cast("long") + 1).count()
        assert bad == 0 and df.count() == n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def write(workdir, name, text):
    with open(os.path.join(workdir, name), "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def test_csv_quotes_short_rows_and_line_breaks(spark, workdir):
    write(workdir, "q.csv", 'a,b,c\n"a ""b"" c",x,1\nshort\n"two, cells",,3\n')
    rows = [tuple(r) for r in read_csv(spark, workdir, "q.csv").collect()]
    assert rows == [('a "b" c', "x", "1"), ("short", None, None), ("two, cells", None, "3")]
    write(workdir, "m.csv", 'a,b\n"line 1\nline 2",y\n')
    assert [tuple(r) for r in read_csv(spark, workdir, "m.csv", multiline=True).collect()] == [("line 1\nline 2", "y")]


def test_csv_long_row_fails(spark, workdir):
    write(workdir, "l.csv", "a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="more than 2 cells"):
        read_csv(spark, workdir, "l.csv").collect()


def test_row_numbers_do_not_shuffle_the_rows(spark, workdir):
    write(workdir, "n.csv", "v\n" + "\n".join(str(i) for i in range(500)) + "\n")
    df = read_csv(spark, workdir, "n.csv", row_id="rid")
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.filter("rid <> cast(v AS bigint) + 1").count() == 0


def test_missing_offset_fails(spark):
    from incidentmart.sources.csv import number_from_offsets
    staged = spark.createDataFrame([("x", "f1", 0, 0), ("y", "f2", 0, 1)], "v string, __file string, __block long, __mid long")
    offsets = spark.createDataFrame([("f1", 0, 0, 0)], "__file string, __block long, __first long, __offset long")
    with pytest.raises(Exception, match="no offset for a split of f2"):
        number_from_offsets(staged, offsets, "rid").collect()


def test_repeated_catalog_key_fails_in_the_plan(spark):
    fact = spark.createDataFrame([(1, 5)], "id int, k int")
    cat = spark.createDataFrame([(5, "a"), (5, "b")], "k int, label string")
    out = left_enrich(fact, cat, ["k"], ["label"], name="codes")
    with pytest.raises(Exception, match="codes: key .'k'. is not unique"):
        out.collect()


def test_surplus_cells_fail_every_plan(spark, workdir):
    from incidentmart.sources.csv import read_csv

    write(workdir, "s.csv", "a,b\n1,2\n3,4,5\n6\n")
    df = read_csv(spark, workdir, "s.csv")
    for plan in (df.select("b").collect, df.count, df.groupBy("b").count().collect, lambda: df.agg({"b": "max"}).collect()):
        with pytest.raises(Exception, match="more than 2 cells"):
            plan()
    write(workdir, "ok.csv", "a,b\n1,2\n6\n")
    ok = read_csv(spark, workdir, "ok.csv")
    assert ok.count() == 2 and sorted(r.b or "" for r in ok.select("b").collect()) == ["", "2"]


@pytest.mark.parametrize("header", ["a,a,b", "a,A ,b", '"a","b","a"'])
def test_repeated_header_names_are_refused(spark, workdir, header):
    from incidentmart.sources.csv import read_csv

    write(workdir, "d.csv", f"{header}\n1,2,3\n")
    with pytest.raises(ValueError, match="duplicate column names"):
        read_csv(spark, workdir, "d.csv")


def test_file_without_a_header(spark, workdir):
    from incidentmart.sources.csv import read_csv

    write(workdir, "e.csv", "")
    with pytest.raises(ValueError, match="no header"):
        read_csv(spark, workdir, "e.csv")
