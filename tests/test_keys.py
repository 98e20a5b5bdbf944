from sheetrecon.functions.text import (
    is_decimal_key, is_fillable, is_loose_key, is_strict_key, strip)

CELLS = [None, "", " 642799 ", "\t642799\t", "123", "0123", "12A4", "6427.99", "PROPUESTA JKM",
         "NUMERO", "1234\n", "١٢٣٤", " 6427 ", "642799"]


def _eval(spark, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(CELLS)], "i int, v string")
    return [r.x for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


def test_strict_key(spark):
    got = _eval(spark, is_strict_key("v"))
    want = [False, False, True, True, False, True, False, False, False, False, True, False, True, True]
    assert got == want


def test_strip_matches_python(spark):
    got = _eval(spark, strip("v"))
    assert got == [None if v is None else v.strip() for v in CELLS]


def test_loose_key(spark):
    got = _eval(spark, is_loose_key("v"))
    assert got == [bool(v and v.strip()) for v in CELLS]


def test_decimal_key(spark):
    got = _eval(spark, is_decimal_key("v"))
    want = [False, False, False, False, True, True, False, True, False, False, False, False, False, True]
    assert got == want


def test_fillable_tokens(spark):
    vals = [None, "", "  ", "CLIENTE", "nan", "None", "null", "ANA", "cliente", " None "]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r.x for r in df.select("i", is_fillable("v").alias("x")).orderBy("i").collect()]
    assert got == [True, True, True, True, True, True, True, False, False, True]
    legacy = [r.x for r in df.select("i", is_fillable("v", ("", "CLIENTE", "nan", "None")).alias("x"))
              .orderBy("i").collect()]
    assert legacy[6] is False
