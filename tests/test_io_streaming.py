import glob
import os

import pytest

from fixtures import write
from fixtures import catalog
from sheetrecon.operators import runlog as rl
from sheetrecon.plans.pipeline import FillRequest
from sheetrecon.sources import files as fs
from sheetrecon.sources import sheet as sh
from sheetrecon.sources.sinks import write_sheet
from sheetrecon.streaming.incremental import start_incremental_fill, stream_sheet_lines


def test_write_read_round_trip(spark, tmpdir_path):
    src = write(os.path.join(tmpdir_path, "in.csv"), "a,,c\n\nx,y,\n1,2,3\n")
    s = sh.read_sheet(spark, src, 3)
    out = os.path.join(tmpdir_path, "out")
    write_sheet(s, out, num_parts=2)
    parts = sorted(glob.glob(os.path.join(out, "part-*")))
    text = "".join(open(p).read() for p in parts)
    assert text == "a,,c\n,,\nx,y,\n1,2,3\n"


def test_per_sheet_header(spark, tmpdir_path):
    for n in ("a", "b"):
        write(os.path.join(tmpdir_path, f"{n}.csv"), f"{n}1,{n}2\n{n}3,{n}4\n")
    s = sh.read_sheet(spark, tmpdir_path, 2)
    out = os.path.join(tmpdir_path, "out")
    write_sheet(s, out, header=True, per_sheet=True)
    for n in ("a", "b"):
        parts = sorted(glob.glob(os.path.join(out, f"sheet={n}.csv-*", "part-*")))
        text = "".join(open(p).read() for p in parts)
        assert text.splitlines() == ["c0,c1", f"{n}1,{n}2", f"{n}3,{n}4"]


def test_list_generate_and_summary(spark, tmpdir_path):
    write(os.path.join(tmpdir_path, "real.csv"), "x\n")
    write(os.path.join(tmpdir_path, "test_skip.csv"), "x\n")
    names = [r.name for r in fs.list_sheets(spark, tmpdir_path).collect()]
    assert names == ["real.csv"]
    g = fs.generate_sheet(spark, 1000)
    assert g.count() == 1010
    assert g.filter("row_no = 11").first().c1 == "642799"
    assert g.filter("row_no = 10").first().c1 == "PROPUESTA JKM"
    p = write(os.path.join(tmpdir_path, "s3.csv"),
              "a,b,c\n" * 10 + "1,642799,x\n2,10153,y\n3,116090,z,extra\n")
    s = sh.read_sheet(spark, p, 3)
    summ = fs.sheet_summary(s, sh.number_lines(spark, p)).first()
    assert (summ.total_rows, summ.total_cols, summ.n_keys) == (13, 4, 3)
    assert summ.key_samples == ["642799", "10153"]


def test_run_log_totals_and_running(spark):
    log = spark.createDataFrame([(1, 1, 10, 2.5, True), (2, 1, 20, 1.5, False), (3, 2, 5, 1.0, True)],
                                "run long, src long, records long, execution_time double, success boolean")
    t = rl.run_log_totals(log).first()
    assert (t.runs, t.total_records, t.errors) == (3, 35, 1)
    assert float(t.total_seconds) == 5.0 and t.avg_seconds == round(5 / 3, 6)
    ra = {r.run: r.running_avg for r in rl.running_average(log, "execution_time", ["run"], ["src"]).collect()}
    assert ra == {1: 2.5, 2: 2.0, 3: 1.0}
    checks = spark.createDataFrame([("a", True), ("b", False), ("c", True)], "check string, success boolean")
    cs = rl.check_summary(checks).first()
    assert (cs.passed, cs.failed, cs.all_ok) == (2, 1, False)
    assert rl.check_summary(checks, min_passed=2).first().all_ok


def test_incremental_fill_stream(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    banner = "".join("banner,,,,,\n" for _ in range(10))
    write(os.path.join(landing, "one.csv"), banner + "1,10153,,,,\n2,999,,,,CLIENTE\n")
    out = os.path.join(tmpdir_path, "out")
    q = start_incremental_fill(spark, landing, catalog(spark), out, os.path.join(tmpdir_path, "ck"),
                               n_cols=6, req=FillRequest(targets={"c5": "nombre_cliente"},
                                                         dimension_filters=False))
    q.awaitTermination(120)
    rows = {r.row_no: r for r in spark.read.parquet(out).collect()}
    assert rows[11].c5 == "CARLA" and rows[11].filled
    assert rows[12].c5 == "CLIENTE" and not rows[12].filled
    assert len(rows) == 12


def test_stream_lines_positions(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "l2")
    os.makedirs(landing)
    write(os.path.join(landing, "a.csv"), "x\n\ny\r\nz\n")
    lines = stream_sheet_lines(spark, landing)
    q = lines.writeStream.format("memory").queryName("lines_t").trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = sorted((r.row_no, r.value) for r in spark.sql("SELECT * FROM lines_t").collect())
    assert got == [(1, "x"), (2, ""), (3, "y"), (4, "z")]


def test_running_totals_stream(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "log")
    spark.createDataFrame([(10, 2.5, True), (20, 1.5, False)],
                          "records long, execution_time double, success boolean").write.parquet(src)
    stream = spark.readStream.schema("records long, execution_time double, success boolean").parquet(src)
    q = (rl.run_log_totals(stream).writeStream.outputMode("complete").format("memory")
         .queryName("totals_t").trigger(availableNow=True).start())
    q.awaitTermination(60)
    r = spark.sql("SELECT * FROM totals_t").first()
    assert (r.runs, r.total_records, r.errors) == (2, 30, 1)


def test_batch_fill_job(spark, tmpdir_path):
    from sheetrecon.plans.jobs import run_fill_job
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    banner = "".join("banner,,,,,\n" for _ in range(10))
    write(os.path.join(src, "a.csv"), banner + "1,10153,,,,\n2,999,,,,CLIENTE\n")
    write(os.path.join(src, "b.csv"), banner + "1,116090,,,,nan\n")
    out = os.path.join(tmpdir_path, "out")
    summary = {os.path.basename(r.file_path): r for r in run_fill_job(
        spark, src, catalog(spark), out, 6,
        FillRequest(targets={"c5": "nombre_cliente"}, dimension_filters=False),
        run_log_dir=os.path.join(tmpdir_path, "log")).collect()}
    assert (summary["a.csv"].data_rows, summary["a.csv"].filled) == (2, 1)
    assert summary["b.csv"].filled == 1
    a_text = "".join(open(p).read() for p in sorted(glob.glob(os.path.join(out, "sheets", "sheet=a.csv-*", "part-*"))))
    assert a_text.splitlines()[10] == "1,10153,,,,CARLA"
    log = os.path.join(tmpdir_path, "log")
    assert spark.read.parquet(log).count() == 1
    with pytest.raises(ValueError):
        run_fill_job(spark, src, catalog(spark), out, 6, FillRequest(targets={"c21": "monto"}), run_log_dir=log)
    from sheetrecon.operators.runlog import run_log_totals
    t = run_log_totals(spark.read.parquet(log)).first()
    assert (t.runs, t.errors, t.total_records) == (2, 1, 2)


def test_incremental_fill_multi_split_file(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    banner = "".join("banner,,,,,\n" for _ in range(10))
    body = "".join(f"{i},{'10153' if i % 2 else '999'},,,,\n" for i in range(200))
    write(os.path.join(landing, "big.csv"), banner + body)
    out = os.path.join(tmpdir_path, "out")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        q = start_incremental_fill(spark, landing, catalog(spark), out, os.path.join(tmpdir_path, "ck"),
                                   n_cols=6, req=FillRequest(targets={"c5": "nombre_cliente"},
                                                             dimension_filters=False))
        q.awaitTermination(120)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 210
    assert all(int(r.c0) + 11 == r.row_no for r in rows if r.row_no > 10)
    assert sum(1 for r in rows if r.filled) == 100


def test_per_sheet_order_across_many_parts(spark, tmpdir_path):
    rows = [f"{i},v{i}" for i in range(600)]
    write(os.path.join(tmpdir_path, "big.csv"), "\n".join(rows) + "\n")
    write(os.path.join(tmpdir_path, "small.csv"), "x,y\n")
    s = sh.read_sheet(spark, tmpdir_path, 2)
    out = os.path.join(tmpdir_path, "out")
    write_sheet(s, out, per_sheet=True, header=True, num_parts=5)
    parts = sorted(glob.glob(os.path.join(out, "sheet=big.csv-*", "part-*")))
    assert len(parts) > 1
    text = "".join(open(p).read() for p in parts).splitlines()
    assert text == ["c0,c1"] + rows


def test_stream_checkpoint_default_under_session_dir(spark):
    from sheetrecon.session import ensure_checkpoint_dir
    from sheetrecon.streaming.incremental import stream_checkpoint
    a = stream_checkpoint(spark, "/data/out/a")
    assert a.startswith(ensure_checkpoint_dir(spark).rstrip("/") + "/streams/")
    assert a == stream_checkpoint(spark, "/data/out/a") != stream_checkpoint(spark, "/data/out/b")


def test_sheets_of_one_name_stay_apart(spark, tmpdir_path):
    for d in ("x", "y"):
        os.makedirs(os.path.join(tmpdir_path, d))
        write(os.path.join(tmpdir_path, d, "a.csv"), f"{d}1,{d}2\n{d}3,{d}4\n")
    s = sh.read_sheet(spark, os.path.join(tmpdir_path, "*", "a.csv"), 2)
    out = os.path.join(tmpdir_path, "out")
    write_sheet(s, out, per_sheet=True)
    folders = glob.glob(os.path.join(out, "sheet=a.csv-*"))
    texts = sorted("".join(open(p).read() for p in sorted(glob.glob(os.path.join(f, "part-*")))) for f in folders)
    assert texts == ["x1,x2\nx3,x4\n", "y1,y2\ny3,y4\n"]


def test_stream_reads_records_and_encodings_as_batch_does(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    banner = "".join("banner,,,,,\n" for _ in range(10))
    body = '1,10153,"two\nlines",,,\n2,10153,Peña 12" x,,,\n3,999,,,,\n'
    write(os.path.join(landing, "utf8.csv"), banner + body)
    write(os.path.join(landing, "latin.csv"), banner + body, encoding="latin-1")
    out = os.path.join(tmpdir_path, "out")
    req = FillRequest(targets={"c5": "nombre_cliente"}, dimension_filters=False)
    q = start_incremental_fill(spark, landing, catalog(spark), out, os.path.join(tmpdir_path, "ck"), n_cols=6, req=req)
    q.awaitTermination(300)
    got = spark.read.parquet(out).where("row_no > 10").orderBy("file_path", "row_no").collect()
    assert [(r.row_no, r.c0, r.c2, r.c5) for r in got] == 2 * [
        (11, "1", "two\nlines", "CARLA"), (12, "2", 'Peña 12" x', "CARLA"), (13, "3", None, None)]


def test_running_totals_count_a_run_once(spark, tmpdir_path):
    import datetime

    from sheetrecon.streaming.incremental import running_totals
    src = os.path.join(tmpdir_path, "log")
    at = datetime.datetime(2024, 1, 1, 12)
    rows = [("a", at, 10, 2.5, True), ("b", at, 20, 1.5, False)]
    schema = "run string, logged_at timestamp, records long, execution_time double, success boolean"
    for _ in range(2):  # the same rows arrive in a second file
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (running_totals(stream, run_id="run").writeStream.outputMode("complete").format("memory")
         .queryName("once_t").trigger(availableNow=True).start())
    q.awaitTermination(120)
    r = spark.sql("SELECT * FROM once_t").first()
    assert (r.runs, r.total_records, r.errors) == (2, 30, 1)
