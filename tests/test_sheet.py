import os

from fixtures import write
from sheetrecon.sources import sheet as sh

# SH1-like: 10 banner rows (rows 4-6 have 5 fields), then 5 data rows.
SH1 = "\n".join([
    "ORDEN DE VENTA,,,,,", "EMPRESA,,,,,", ",,,,,", "a,b,c,d,e", "a,b,c,d,e", "a,b,c,d,e",
    ",,,,,", ",,,,,", ",,,,,", "ORDEN,PROPUESTA JKM,FECHA,PRIORIDAD,IMPORTE,CLIENTE",
    "1,642799,2024-01-01,A,100,", "2,642800,2024-01-02,B,200,", ",642801,2024-01-03,C,300,",
    "4,642802,2024-01-04,D,400,", "5,642803,2024-01-05,E,500,"]) + "\n"


def test_row_numbers_exact_across_small_splits(spark, tmpdir_path):
    lines = {}
    for f in range(3):
        rows = [("" if i % 17 == 0 else f"{f},{i},\"q,x\",tail{i}") for i in range(400)]
        lines[f"s{f}.csv"] = rows
        write(os.path.join(tmpdir_path, f"s{f}.csv"), "\n".join(rows) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        got = sh.number_lines(spark, tmpdir_path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 1200
    for r in got:
        assert lines[os.path.basename(r.file_path)][r.row_no - 1] == r.value
    per_file = {}
    for r in got:
        per_file.setdefault(r.file_path, []).append(r.row_no)
    for nums in per_file.values():
        assert sorted(nums) == list(range(1, 401))


def test_parse_pads_truncates_and_keeps_blank_lines(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "r.csv"), "a,b\n\nx,y,z,w,v\n\"q,1\",2\n")
    df = sh.read_sheet(spark, p, 3).orderBy("row_no").collect()
    assert [r.row_no for r in df] == [1, 2, 3, 4]
    assert (df[0].c0, df[0].c1, df[0].c2) == ("a", "b", None)
    assert (df[1].c0, df[1].c1, df[1].c2) == (None, None, None)
    assert (df[2].c0, df[2].c1, df[2].c2) == ("x", "y", "z")
    assert (df[3].c0, df[3].c1) == ("q,1", "2")


def test_bom_dropped_and_null_tokens(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "bom.csv")
    with open(p, "wb") as f:
        f.write("﻿k,v\n1,NULL\n2,#N/D\n3,null\n4,ok\n".encode("utf-8"))
    s = sh.read_sheet(spark, p, 2)
    first = s.filter("row_no = 1").first()
    assert first.c0 == "k"
    clean = sh.clean_null_tokens(s).orderBy("row_no").collect()
    assert [r.c1 for r in clean] == ["v", None, None, None, "ok"]


def test_separator_and_fields_per_line(spark, tmpdir_path):
    write(os.path.join(tmpdir_path, "tab.csv"), SH1.replace(",", "\t"))
    write(os.path.join(tmpdir_path, "comma.csv"), SH1)
    lines = sh.number_lines(spark, tmpdir_path)
    seps = {os.path.basename(r.file_path): r.sep for r in sh.detect_separator(lines).collect()}
    assert seps == {"tab.csv": "\t", "comma.csv": ","}
    fpl = sh.fields_per_line(lines, max_rows=16).filter("row_no = 10").collect()
    assert {r.n_fields for r in fpl} == {6}
    assert sh.infer_width(lines) == 6


def test_data_region_head_and_width_guard(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "sh1.csv"), SH1)
    s = sh.read_sheet(spark, p, 6)
    assert sh.data_region(s, 11).count() == 5
    assert sh.head_rows(s, 3).count() == 3
    sh.require_width(s, 6)
    try:
        sh.require_width(s, 7)
        raise AssertionError("expected a width error")
    except ValueError:
        pass
    assert s.select(sh.column_at(s, 1).alias("b")).filter("b = '642801'").count() == 1


def test_multiline_cells(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "ml.csv"), "a,\"x\ny\"\nb,c\n")
    rows = sh.read_sheet(spark, p, 2, multi_line=True).orderBy("row_no").collect()
    assert [(r.row_no, r.c0, r.c1) for r in rows] == [(1, "a", "x\ny"), (2, "b", "c")]


def test_quoted_newlines_across_splits_and_blank_records(spark, tmpdir_path):
    rows = []
    for i in range(400):
        rows.append((f"k{i}", f"first {i}\nsecond, \"\"{i}\"\"\n\nlast" if i % 7 == 0 else f"v{i}"))
        if i % 50 == 3:
            rows.append(None)
    text = "".join("\n" if r is None else f'{r[0]},"{r[1]}"\n' for r in rows)
    p = write(os.path.join(tmpdir_path, "big.csv"), text)
    write(os.path.join(tmpdir_path, "open.csv"), 'a,b\nc,"d\ne,f\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        got = sh.read_sheet(spark, p, 2).orderBy("row_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.row_no for r in got] == list(range(1, len(rows) + 1))
    for r, want in zip(got, rows):
        assert (r.c0, r.c1) == ((None, None) if want is None else (want[0], want[1].replace('""', '"'))), want
    unclosed = sh.read_sheet(spark, os.path.join(tmpdir_path, "open.csv"), 2).orderBy("row_no").collect()
    assert [r.c0 for r in unclosed] == ["a", "c", "e"]
    plain = sh.read_sheet(spark, p, 2, multi_line=False)
    assert plain.count() == text.count("\n")


def test_typed_scan_with_header(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "sh4.csv"),
              "PROPUESTA JKM / LEGAJO,CLIENTE,COLUMNA3\n123,ANA,x\n456,LUIS,y\n789,EVA,z\n")
    df = sh.read_typed_sheet(spark, p, ["propuesta", "cliente", "columna3"])
    assert df.count() == 3
    assert dict(df.dtypes) == {"propuesta": "string", "cliente": "string", "columna3": "string"}
    from sheetrecon.functions.text import is_strict_key
    assert df.filter(is_strict_key("propuesta")).count() == 0
