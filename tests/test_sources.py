"""File sources, generators and helper functions on small hand-made inputs."""

import pytest
from pyspark.sql import functions as F

from lakejobs.operators.profile import null_report
from lakejobs.operators.relational import has_columns
from lakejobs.plans.relational import add_derived_column, filter_by_threshold
from lakejobs.sources import files, generators
from lakejobs.streaming.sinks import append_files, append_table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def run(spark, stream, root):
    append_files(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return rows(spark.read.parquet(f"{root}/out"))


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [(1, "a", 100.0, 10.0), (2, "b", 200.0, 20.0), (3, "c", 300.0, 30.0)], "id long, name string, sales double, commission double")


def test_helpers(sales):
    assert rows(add_derived_column(sales, "sales", "commission", "total"))[0][-1] == 110.0
    assert has_columns(sales, ["id", "sales"]) and has_columns(sales, []) and not has_columns(sales, ["id", "x"])


@pytest.mark.parametrize("threshold, expected", [(50, 4), (150, 2), (250, 1), (400, 0)])
def test_threshold(spark, threshold, expected):
    amounts = spark.createDataFrame([(1, 100.0), (2, 120.0), (3, 200.0), (4, 300.0)], "id long, amount double")
    assert filter_by_threshold(amounts, "amount", threshold).count() == expected


def test_null_report(spark):
    df = spark.createDataFrame([(i, None if i < 2 else 1.0) for i in range(5)], "id long, amount double")
    assert rows(null_report(df, ["amount", "id"])) == [("amount", 5, 2, 3, 40.0), ("id", 5, 0, 5, 0.0)]
    assert rows(null_report(df.limit(0), ["id"])) == [("id", 0, 0, 0, 0.0)]


def test_streams_see_only_new_files(spark, sales, tmp_path):
    root = str(tmp_path)
    sales.write.option("header", True).csv(f"{root}/in")
    schema = "id long, name string, sales double, commission double"
    assert len(run(spark, files.stream_csv(spark, f"{root}/in", schema), root)) == 3
    sales.limit(1).write.mode("append").option("header", True).csv(f"{root}/in")
    assert len(run(spark, files.stream_csv(spark, f"{root}/in", schema), root)) == 4


def test_inferred_schema_is_remembered_and_merged(spark, sales, tmp_path):
    root = str(tmp_path)
    sales.select("id", "name").write.option("header", True).csv(f"{root}/in")
    first = files.stream_csv_inferred(spark, f"{root}/in", f"{root}/schema")
    assert [f.dataType.simpleString() for f in first.schema.fields] == ["int", "string", "string"]
    old = files.load_schema(spark, f"{root}/schema")
    new = spark.createDataFrame([], "id string, extra double").schema
    assert files.merge_schemas(old, new).simpleString() == "struct<id:string,name:string,extra:double>"
    assert files.load_schema(spark, f"{root}/none") is None
    wider = spark.createDataFrame([], "id double, name string").schema
    assert files.merge_schemas(old, wider).simpleString() == "struct<id:double,name:string>"
    # A file with one column more is seen at the next start, and kept rows are not read again.
    run(spark, first, root)
    sales.select("id", "name", "sales").limit(1).write.mode("append").option("header", True).csv(f"{root}/in")
    again = files.stream_csv_inferred(spark, f"{root}/in", f"{root}/schema")
    assert again.columns == ["id", "name", "sales", "_rescued_data"]


def test_values_of_older_files_survive(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("x7", "old")], "id string, name string").write.option("header", True).csv(f"{root}/in")
    spark.createDataFrame([(8, "new")], "id int, name string").write.mode("append").option("header", True).csv(f"{root}/in")
    stream = files.stream_csv_inferred(spark, f"{root}/in", f"{root}/schema")
    assert sorted(tuple(r) for r in run(spark, stream, root)) == [("8", "new", None), ("x7", "old", None)]


def test_misfits_of_later_files_are_rescued(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1, "a")], "id int, name string").write.option("header", True).csv(f"{root}/in")
    stream = files.stream_csv_inferred(spark, f"{root}/in", f"{root}/schema")
    spark.createDataFrame([("two", "b")], "id string, name string").write.mode("append").option("header", True).csv(f"{root}/in")
    assert sorted((tuple(r) for r in run(spark, stream, root)), key=repr) == [(1, "a", None), (None, "b", "two,b")]


def test_rescued_data(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"id": 1, "name": "a"}\n{"id": 2, "name": "b", "age": 7, "geo": {"x": 1}}\n')
    found = files.read_json_rescued(spark, str(tmp_path / "in.json"), "id long, name string")
    assert rows(found) == [(1, "a", None), (2, "b", '{"age":"7","geo":"{\\"x\\":1}"}')]


def test_failfast_stops(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,amount\n1,2\nx,3\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        files.read_csv(spark, str(tmp_path / "in.csv"), schema="id int, amount int", fail_fast=True).collect()
    assert files.read_csv(spark, str(tmp_path / "in.csv"), schema="id int, amount int").count() == 2


def test_copy_into_is_idempotent(spark, sales, tmp_path):
    root = str(tmp_path)
    sales.write.option("sep", "|").csv(f"{root}/in")
    call = (spark, f"{root}/in", f"{root}/out", f"{root}/ledger", {"id": "CAST(_c0 AS BIGINT)", "who": "_c1"})
    files.copy_into(*call)
    files.copy_into(*call)
    assert rows(spark.read.parquet(f"{root}/out")) == [(1, "a"), (2, "b"), (3, "c")]
    sales.limit(1).write.mode("append").option("sep", "|").csv(f"{root}/in")
    files.copy_into(*call)
    assert spark.read.parquet(f"{root}/out").count() == 4


def test_xml_attributes_and_nesting(spark, tmp_path):
    (tmp_path / "b.xml").write_text(
        '<books><book id="1"><author>A</author><title>T</title><tag>x</tag><tag>y</tag></book><book id="2"><author>B</author></book></books>')
    found = files.read_xml(spark, str(tmp_path / "b.xml"), "book").orderBy("_id").collect()
    assert [r["_id"] for r in found] == [1, 2] and found[0]["tag"] == ["x", "y"]


def test_jdbc_options():
    options = files.jdbc_options(
        {"url": "jdbc:x", "user": "u"}, "t", {"column": "id", "lower": 0, "upper": 100, "parts": 8})
    assert options["numPartitions"] == "8" and options["dbtable"] == "t" and options["user"] == "u"


def test_generators_are_stable(spark):
    orders = generators.orders(spark, 2000).drop("updated_at")
    assert len(orders.columns) == 15
    assert rows(orders) == rows(generators.orders(spark, 2000).repartition(7).drop("updated_at"))
    share = orders.where("status = 'completed'").count() / 2000
    assert 0.55 < share < 0.65
    assert generators.customers(spark, 100).select("tier").distinct().count() == 3


def test_stream_to_table(spark, sales, tmp_path):
    sales.write.parquet(str(tmp_path / "in"))
    location = str(tmp_path / "bronze")
    spark.sql(f"CREATE TABLE bronze_sales (id BIGINT, name STRING, sales DOUBLE, commission DOUBLE) USING parquet LOCATION '{location}'")
    try:
        append_table(files.stream_parquet(spark, str(tmp_path / "in")), "bronze_sales", str(tmp_path / "c")).awaitTermination()
        assert spark.table("bronze_sales").count() == 3
        # A second run of the same stream finds no new files.
        append_table(files.stream_parquet(spark, str(tmp_path / "in")), "bronze_sales", str(tmp_path / "c")).awaitTermination()
        assert spark.table("bronze_sales").agg(F.count("*")).first()[0] == 3
    finally:
        spark.sql("DROP TABLE bronze_sales")


def lines(spark, path, texts):
    spark.createDataFrame([(x,) for x in texts], "value string").coalesce(1).write.mode("append").text(path)


def test_fields_that_do_not_fit_are_rescued(spark, tmp_path):
    path = str(tmp_path / "in")
    lines(spark, path, ["id,on,n", "1,2024-01-02,5", "x,2024-13-02,5", ",,", "4,2024-01-05", '5,2024-01-06,6,7', '"7","no ""date""",8'])
    found = {(r.id, str(r.on) if r.on else None, r.n, r._rescued_data) for r in files.read_csv_rescued(spark, path, "id int, on date, n long", escape='"').collect()}
    assert found == {
        (1, "2024-01-02", 5, None), (None, None, 5, '{"id":"x","on":"2024-13-02"}'), (None, None, None, None),
        (4, "2024-01-05", None, '{"_line":"4,2024-01-05"}'), (5, "2024-01-06", 6, '{"_line":"5,2024-01-06,6,7"}'),
        (7, None, 8, '{"on":"no \\"date\\""}')}


def test_json_stream_rescues_misfits_unknown_fields_and_broken_lines(spark, tmp_path):
    from lakejobs.streaming import sinks

    root = str(tmp_path)
    lines(spark, f"{root}/in", ['{"id": 1, "n": 2.5}', '{"id": "x", "n": null, "more": [1, 2]}', "no json", "{}"])
    sinks.append_files(files.stream_json_rescued(spark, f"{root}/in", "id long, n double"), f"{root}/out", f"{root}/c").awaitTermination()
    found = {(r.id, r.n, r._rescued_data) for r in spark.read.parquet(f"{root}/out").collect()}
    assert found == {(1, 2.5, None), (None, None, '{"id":"x","more":"[1,2]"}'), (None, None, '{"_line":"no json"}'), (None, None, None)}


def test_inferred_types_come_from_a_sample_and_lose_nothing(spark, tmp_path, monkeypatch):
    from lakejobs.streaming import sinks

    monkeypatch.setattr(files, "INFER_LINES", 3)
    root = str(tmp_path)
    lines(spark, f"{root}/in", ["a,b", "1,x", "2,y", "three,z", "4,w"])
    rows = files.stream_csv_inferred(spark, f"{root}/in", f"{root}/schema", by_field=True)
    assert rows.schema["a"].dataType.simpleString() == "int"
    sinks.append_files(rows, f"{root}/out", f"{root}/c").awaitTermination()
    found = {(r.a, r.b, r._rescued_data) for r in spark.read.parquet(f"{root}/out").collect()}
    assert found == {(1, "x", None), (2, "y", None), (None, "z", '{"a":"three"}'), (4, "w", None)}
    assert [f.name for f in files.load_schema(spark, f"{root}/schema").fields] == ["a", "b"]


def test_merged_load_takes_each_file_once(spark, tmp_path):
    root = str(tmp_path)

    def load():
        files.copy_merged(spark, f"{root}/in", f"{root}/out", f"{root}/ledger", {"id": "bigint"}, separator="|")
        return {(r["id"], r["name"], r["big size"] if "big size" in r else None) for r in files.read_merged(spark, f"{root}/out").collect()}

    lines(spark, f"{root}/in", ["id|name", "1|a", "2|b"])
    lines(spark, f"{root}/in", ["name|id"])
    assert load() == {(1, "a", None), (2, "b", None)}
    lines(spark, f"{root}/in", ["big size|name|id", "9|c|3"])
    assert load() == load() == {(1, "a", None), (2, "b", None), (3, "c", "9")}
    # A batch that is repeated replaces its own folder.
    assert files.read_merged(spark, f"{root}/out").count() == 3
    import shutil

    shutil.copytree(f"{root}/out", f"{root}/copy")
    lines(spark, f"{root}/in", ["id|name", "no|d"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load()
    assert files.read_merged(spark, f"{root}/out").count() == 3
