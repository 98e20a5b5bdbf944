"""Property checks (hypothesis): Column expressions against plain Python."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import write
from sheetrecon.functions.text import is_strict_key, strip
from sheetrecon.sources import sheet as sh

ALPHABET = st.sampled_from(list("0123456789 \t\n\r\x0b\x0c\x1c\x85\xa0　aZ.-,٣"))
CELL = st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=12))
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(CELL, min_size=1, max_size=40))
def test_strip_and_strict_key_match_python(spark, cells):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(cells)], "i int, v string")
    got = df.select("i", strip("v").alias("s"), is_strict_key("v").alias("k")).orderBy("i").collect()
    for r, v in zip(got, cells):
        want_s = None if v is None else v.strip()
        assert r.s == want_s, (v, r.s)
        ascii_digits = want_s is not None and len(want_s) >= 4 and all("0" <= ch <= "9" for ch in want_s)
        assert r.k == ascii_digits, (v, r.k)


@SETTINGS
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab,1 ")), max_size=30), min_size=1, max_size=300),
       st.integers(min_value=200, max_value=3000))
def test_line_numbers_are_positions(spark, tmp_path_factory, lines, split):
    d = str(tmp_path_factory.mktemp("lines"))
    p = write(os.path.join(d, "f.csv"), "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = sorted((r.row_no, r.value) for r in sh.number_lines(spark, p).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate(lines, start=1))
