"""Records, encodings and separators of files read in many splits."""

import os
import random

import pytest
from pyspark.sql import functions as F

from fixtures import write
from sheetrecon.sources import records as rc
from sheetrecon.sources import sheet as sh


@pytest.fixture()
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def by_row(df):
    return [tuple(r)[2:] for r in df.orderBy("row_no").collect()]


def opens(line, sep):
    """A plain reading of a line from its start: is its end inside a quoted cell?"""
    i, inside, start = 0, False, True
    while i < len(line):
        if inside:
            if line[i] == '"':
                if line[i + 1:i + 2] == '"':
                    i += 1
                else:
                    inside, start = False, False
        elif line[i] == sep:
            start = True
        elif line[i] == '"' and start:
            inside = True
        else:
            start = False
        i += 1
    return inside


def from_inside(line, sep):
    """Of a line that begins inside a quoted cell: (no quote ends it, it ends well, and is
    followed by a cell that is open at the end)."""
    at = line.replace('""', "  ").find('"')
    rest = line[at + 1:]
    return at < 0, at >= 0 and rest[:1] in ("", sep), at >= 0 and rest[:1] == sep and opens(rest[1:], sep)


def plain_records(lines, sep, limit):
    """Records of the lines of a file, one line after the other."""
    def hop(k):
        return next((n if from_inside(lines[n], sep)[1] and n - k < limit else None
                     for n in range(k + 1, len(lines)) if not from_inside(lines[n], sep)[0]), None)

    out, i = [], 0
    while i < len(lines):
        j = i
        if opens(lines[i], sep) and (k := hop(i)) is not None:
            while from_inside(lines[k], sep)[2] and hop(k) is not None:
                k = hop(k)
            j = k if k - i < limit else i
        out.append("\n".join(lines[i:j + 1]))
        i = j + 1
    return out


def scan(spark, files, block):
    """Lines of made-up files in blocks of ``block`` lines, as a text scan gives them."""
    rows = [(f, k // block * 10, (k // block << 33) + k % block, line)
            for f, lines in files.items() for k, line in enumerate(lines)]
    return spark.createDataFrame(rows, "file_path string, _blk long, _id long, value string").repartition(5)


@pytest.mark.parametrize("limit", [3, 1000])
def test_records_follow_a_plain_reading(spark, limit):
    r = random.Random(limit)
    parts = ['"', '""', ",", ",\"", "\",", "a", "bc ", "\t", "\t\"", "\"x\""]
    files = {f"f{n}": ["".join(r.choices(parts, k=r.choice([0, 1, 2, 4, 9]))) for _ in range(r.choice([1, 7, 60]))]
             for n in range(60)}
    for sep, block in ((",", 1000), (None, 4)):
        got = {}
        for x in rc.records(scan(spark, files, block), sep, max_lines=limit).collect():
            got.setdefault(x.file_path, {})[x.row_no] = (x.value, x.sep)
        for f, lines in files.items():
            own = sep or ("\t" if "\t" in lines[0] else ",")
            want = plain_records(lines, own, limit)
            assert got[f] == {k + 1: (v, own) for k, v in enumerate(want)}, (f, lines)


def test_stray_quotes_keep_all_rows(spark, tmpdir_path, small_splits):
    rows = [f"k{i},v{i},tail" for i in range(300)]
    rows[20] = 'k20,12" pipe,tail'
    rows[40] = 'k40,"never closed,tail'
    rows[60] = '"k60","a\nb ""c""",tail'
    p = write(os.path.join(tmpdir_path, "stray.csv"), "\n".join(rows) + "\n")
    got = by_row(sh.read_sheet(spark, p, 3))
    assert len(got) == 300
    assert [g[0] for g in got] == [f"k{i}" for i in range(300)]
    assert got[20][1] == '12" pipe' and got[60][1] == 'a\nb "c"'
    assert got[299] == ("k299", "v299", "tail")


def test_a_record_has_a_bounded_number_of_lines(spark, tmpdir_path, small_splits):
    lines = ['a,"open'] + [f"x{i},y" for i in range(200)] + ['close",b', "z,w"]
    p = write(os.path.join(tmpdir_path, "long.csv"), "\n".join(lines) + "\n")
    assert sh.read_sheet(spark, p, 2, max_lines=50).count() == len(lines)
    assert sh.read_sheet(spark, p, 2).count() == 2


def test_one_encoding_for_each_file(spark, tmpdir_path, small_splits):
    text = "clave,cliente\n" + "".join(f"{i},Peña Núñez {i}\n" if i % 40 == 7 else f"{i},plain {i}\n" for i in range(200))
    for name, data in {"utf8.csv": text.encode(), "bom.csv": b"\xef\xbb\xbf" + text.encode(),
                       "latin.csv": text.encode("latin-1"), "ascii.csv": text.encode("ascii", "ignore")}.items():
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(data)
    # bytes of this file are valid UTF-8 in most lines, but not in all
    mixed = "k,v\n1,Ã©\n".encode("latin-1") + "2,é\n".encode("latin-1")
    with open(os.path.join(tmpdir_path, "mixed.csv"), "wb") as f:
        f.write(mixed)
    sheet = sh.read_sheet(spark, tmpdir_path, 2)
    files = {os.path.basename(r.file_path) for r in sheet.select("file_path").distinct().collect()}
    assert files == {"utf8.csv", "bom.csv", "latin.csv", "ascii.csv", "mixed.csv"}
    want = [tuple(line.split(",")) for line in text.splitlines()]
    for name in ("utf8.csv", "bom.csv", "latin.csv"):
        assert by_row(sheet.where(F.col("file_path").endswith("/" + name))) == want, name
    assert by_row(sheet.where(F.col("file_path").endswith("mixed.csv"))) == [("k", "v"), ("1", "Ã©"), ("2", "é")]


def test_separator_of_each_file_in_one_scan(spark, tmpdir_path, small_splits):
    want = [(f"k{i}", f"a, b {i}" if i % 3 else f"line\n{i}") for i in range(120)]
    quoted = lambda s: f'"{s}"'
    write(os.path.join(tmpdir_path, "tab.csv"), "".join(f"{a}\t{quoted(b)}\n" for a, b in want))
    write(os.path.join(tmpdir_path, "comma.csv"), "".join(f"{a},{quoted(b)}\n" for a, b in want))
    sheet = sh.read_sheet(spark, tmpdir_path, 2, sep=None)
    for name in ("tab.csv", "comma.csv"):
        assert by_row(sheet.where(F.col("file_path").endswith(name))) == want


def test_the_plan_runs_nothing_and_reads_twice(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "s.csv"), 'a,"b"\nc,"d\ne,f\n')
    group = "records-plan"
    spark.sparkContext.setJobGroup(group, "plan")
    try:
        sheet = sh.read_sheet(spark, p, 2)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    sheet.collect()
    plan = sheet._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Scan text") <= 2, final
