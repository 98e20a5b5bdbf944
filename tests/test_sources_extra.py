import os

from fixtures import write
from fixtures import catalog
from sheetrecon.functions.fmt import basename, processed_path
from sheetrecon.operators import lookup as lk
from sheetrecon.sources import sheet as sh
from sheetrecon.sources import tables as tb


def test_inferred_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([(f"c{i}", f"v{i}", i) for i in range(10000)],
                               "col1 string, col2 string, col3 int")
    out = os.path.join(tmpdir_path, "rt")
    df.write.option("header", True).csv(out)
    back = tb.read_inferred_csv(spark, out)
    assert back.count() == 10000
    assert dict(back.dtypes)["col3"] == "int"


def test_parquet_catalog_round_trip_and_pushdown(spark, tmpdir_path):
    cat = catalog(spark)
    root = os.path.join(tmpdir_path, "cat")
    tb.export_catalog({"propuesta": cat["propuesta"]}, root, {"propuesta": "cod_propuesta"}, buckets=2)
    back = tb.parquet_catalog(spark, root, ["propuesta"])["propuesta"]
    assert back.count() == 5
    f = tb.key_literal_filter(back, "legajo", ["10153"])
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "10153" in plan
    assert f.count() == 1


def test_probe_or_first(spark):
    rows = lk.lookup_core(catalog(spark))
    hit = lk.lookup_by_key_or_first(rows, "116090", ["nombre_cliente"]).collect()
    assert [r.legajo for r in hit] == ["116090"]
    miss = lk.lookup_by_key_or_first(rows, "nope", ["nombre_cliente"]).collect()
    assert [r.legajo for r in miss] == ["10153"]        # lowest key text


def test_paths(spark):
    df = spark.createDataFrame([("/a/b/ORDEN.csv",)], "p string")
    r = df.select(processed_path("p").alias("x"), basename("p").alias("y")).first()
    assert (r.x, r.y) == ("/a/b/ORDEN_processed.csv", "ORDEN.csv")


def test_target_column_found_or_appended(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "s.csv"), "a,b,CLIENTE\n" + "1,2,3\n" * 12)
    s = sh.read_sheet(spark, p, 3)
    s1, name = sh.target_column(s, "CLIENTE")
    assert name == "c2" and s1.columns == s.columns
    s2, name2 = sh.target_column(s, "TELEFONO")
    assert name2 == "c3" and "c3" in s2.columns
