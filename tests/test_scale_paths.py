"""Key pushdown, co-located tables, bit tables and manifests."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from fixtures import catalog, write
from sheetrecon.operators import lookup as lk
from sheetrecon.operators import pick as pk
from sheetrecon.operators import safety
from sheetrecon.sources import sheet as sh
from sheetrecon.sources import sinks
from sheetrecon.sources import tables as tb


@pytest.fixture()
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in [*names, "spark.sql.requireAllClusterKeysForCoPartition"]}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def exchanged(df):
    """The columns that each exchange of the plan deals rows out by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [set(re.findall(r"(\w+)#", found)) for found in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]


def test_co_located_catalog_needs_no_exchange(spark, tmpdir_path, no_broadcast):
    cat = catalog(spark)
    tb.export_co_located(cat, os.path.join(tmpdir_path, "tables"), buckets=4)
    try:
        near = tb.co_located_catalog(spark, tables=cat)
        codes = {"p__cod_propuesta", "ct__cod_contrato", "cc__cod_contrato", "cp__cod_contrato_parcela"}
        # the last exchange, of the distinct, has all columns
        assert any(keys <= codes for keys in exchanged(lk.lookup_full(cat)))
        assert not any(keys <= codes for keys in exchanged(lk.lookup_full(near)))
        for lookup in (lk.lookup_full, lk.lookup_core):
            want, got = lookup(cat).collect(), lookup(near).collect()
            assert sorted(map(repr, got)) == sorted(map(repr, want)) and want
        assert near["contratos_clientes"].count() == cat["contratos_clientes"].count()
    finally:
        for name in cat:
            spark.sql(f"DROP TABLE IF EXISTS default.{name}")


def test_bit_table_keeps_members_and_little_else(spark):
    rows = spark.range(200_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None, -1)], "k string, v long"))
    keys = spark.range(0, 400_000, 40).select(F.col("id").cast("string").alias("key"))
    cut = safety.maybe_member(rows, F.col("k"), keys, F.col("key"))
    assert cut.columns == ["k", "v"]
    found = {r.v for r in cut.collect()}
    assert set(range(0, 200_000, 40)) <= found and len(found) <= 5_000 + 100 and -1 not in found
    none = keys.where("false").unionByName(spark.createDataFrame([(None,)], "key string"))
    assert safety.maybe_member(rows, F.col("k"), none, F.col("key")).count() == 0


def test_large_key_set_cuts_the_rows_before_the_shuffle(spark, monkeypatch):
    cat = catalog(spark)
    keys = spark.createDataFrame([("10153",), ("500",), ("999",), (None,)], "key string")
    want = sorted(map(repr, lk.lookup_core(cat, keys).collect()))
    monkeypatch.setattr(lk, "broadcast_if_small", lambda df: df)
    large = lk.lookup_core(cat, keys)
    assert "bitmap_construct_agg" in large._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(repr, large.collect())) == want and want


def test_key_predicates_lists_and_ranges(spark):
    names = [str(i) for i in range(0, 3000, 3)] + ["007", " 42 "]
    keys = spark.createDataFrame([(n,) for n in [*names, None, "3"]], "key string")
    rows = spark.range(3100).select(F.col("id").cast("string").alias("legajo")).unionByName(
        spark.createDataFrame([("007",), (" 42 ",)], "legajo string"))
    wanted = {n.strip() for n in names}
    for max_in, form in ((1000, " IN ("), (10, " >= ")):
        clauses = tb.key_predicates(keys, "legajo", 8, max_in)
        assert 1 < len(clauses) <= 8 and all(form in c for c in clauses)
        read = [r.legajo for c in clauses for r in rows.where(c).collect()]
        assert len(read) == len(set(read))  # no row is read twice
        assert wanted & {r.legajo.strip() for r in rows.collect()} <= {r.strip() for r in read}
        if form == " IN (":
            assert {r.strip() for r in read} <= wanted
    assert tb.key_predicates(keys.where("false"), "legajo", 8) == ["1 = 0"]
    with pytest.raises(ValueError):
        tb.key_predicates(spark.createDataFrame([("A1",)], "key string"), "legajo", 8)
    assert tb.key_predicates(spark.createDataFrame([(5,), (12,)], "c long"), "cod", 1) == ["cod IN (5, 12)"]


def test_keyed_catalog_reads_only_the_keys_rows(spark):
    whole, asked = catalog(spark), {}

    def read(table, predicates):
        asked[table] = predicates
        if predicates is None:
            return whole[table]
        parts = [whole[table].where(p) for p in predicates]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    keys = spark.createDataFrame([("10153",), ("500",)], "key string")
    cut = tb.keyed_catalog(read, keys, whole, reads=2)
    assert sorted(r.legajo for r in cut["propuesta"].collect()) == ["10153", "500"]
    assert {r.cod_contrato for r in cut["contratos_clientes"].collect()} == {11, 13}
    assert asked["sucursales"] is None and asked["contratos"] == ["cod_propuesta IN (1)", "cod_propuesta IN (3)"]
    want = sorted(map(repr, lk.lookup_full(whole, keys).collect()))
    assert sorted(map(repr, lk.lookup_full(cut, keys).collect())) == want and want


def test_an_unpartitioned_fact_table_is_refused(spark):
    with pytest.raises(ValueError, match="contratos"):
        tb.jdbc_catalog(spark, "jdbc:none", {}, ["contratos", "sucursales"])


def whole_bytes(parts):
    rows, at, out = sorted(parts.collect(), key=lambda r: r.start), 0, b""
    for r in rows:
        assert r.start == at
        at += len(r.content)
        out += bytes(r.content)
    return out


def test_manifest_makes_one_logical_file(spark, tmpdir_path):
    text = "".join(f"{i},x{i},é{i}\n" for i in range(500))
    out = os.path.join(tmpdir_path, "out")
    os.makedirs(os.path.join(tmpdir_path, "in"))
    src = write(os.path.join(tmpdir_path, "in", "a.csv"), text)
    sheet = sh.read_sheet(spark, src, 3)
    sinks.write_sheet(sheet, out, num_parts=7, manifest=True)
    # what a failed attempt of a task may leave behind is no part of the file
    stray = sorted(glob.glob(os.path.join(out, "part-*.csv")))[1].replace("part-00001", "part-00001-again")
    with open(stray, "w") as f:
        f.write("0,stray,row\n")
    listed = sinks.read_manifest(spark, out)
    assert listed.count() == 7 and listed.select("start").distinct().count() >= 1
    assert whole_bytes(sinks.sheet_parts(spark, out)) == text.encode()
    few = sinks.sheet_parts(spark, out, first=10, last=20)
    assert few.count() == 1
    assert sh.read_sheet(spark, src, 3).count() == 500
    victim = next(r.part for r in listed.collect() if r.length)
    os.remove(os.path.join(out, f".{victim}.crc"))
    with open(os.path.join(out, victim), "a") as f:
        f.write("more\n")
    with pytest.raises(Exception, match="differs from the manifest"):
        sinks.sheet_parts(spark, out).collect()
    with pytest.raises(ValueError):
        sinks.write_sheet(sheet, out, mode="append", manifest=True)
    sinks.write_sheet(sheet, out, num_parts=2)
    assert not os.path.exists(os.path.join(out, sinks.MANIFEST))


def test_manifest_per_sheet(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "in")
    os.makedirs(folder)
    texts = {n: "".join(f"{n}{i},{i}\n" for i in range(40)) for n in ("a", "b")}
    for n, t in texts.items():
        write(os.path.join(folder, f"{n}.csv"), t)
    out = os.path.join(tmpdir_path, "out")
    sinks.write_sheet(sh.read_sheet(spark, folder, 2), out, per_sheet=True, num_parts=3, manifest=True)
    sheets = [r.sheet for r in sinks.read_manifest(spark, out).select("sheet").distinct().collect()]
    assert len(sheets) == 2
    got = {whole_bytes(sinks.sheet_parts(spark, out, s)).decode() for s in sheets}
    assert got == set(texts.values())


def test_ordered_inputs_are_made_once(spark, tmp_path):
    """Bounds, counts and ranks read the checkpointed input, not what made it."""
    rows = [(i % 7, f"n{i:03d}", i) for i in range(200)]
    spark.createDataFrame(rows, "k int, name string, v long").write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t").filter("v >= 20")
    listed = pk.ordered_with_position(t, ["k", "name"])
    running = pk.running_aggregate(t, "v", ["name"], ["k"])
    for out in (listed, running):
        assert "FileScan" not in out._jdf.queryExecution().executedPlan().toString()
    want = sorted((k, n) for k, n, v in rows if v >= 20)
    assert [(r.k, r.name) for r in sorted(listed.collect(), key=lambda r: r.pos)] == want
    total = {k: sum(v for j, _, v in rows if j == k and v >= 20) for k in range(7)}
    assert {k: max(r._run_sum for r in running.collect() if r.k == k) for k in range(7)} == total


def test_full_records_are_dealt_once_and_distinct(spark, no_broadcast):
    """No exchange deals out the 38 columns, and one deals sales and parties out by client;
    repeated rows of any part still give one record."""
    cat = catalog(spark)
    dealt = exchanged(lk.lookup_full(cat))
    assert max(map(len, dealt)) <= 21
    assert dealt.count({"cod_cliente"}) == 1
    flat = lk.flat((*lk.FULL_SALE, lk.Link("cc", "contratos_clientes", (("ct.cod_contrato", "cod_contrato"),)),
                    *lk.FULL_PARTY, lk.Link("c", "clientes", (("cc.cod_cliente", "cod_cliente"),)), *lk.FULL_CLIENT))
    columns = dict(lk.SALE_COLUMNS + lk.PARTY_COLUMNS + lk.CLIENT_COLUMNS)
    twice = dict(cat)
    for name in ("contratos", "contratos_clientes", "contratos_parcelas", "clientes", "medios_cobros", "barrios"):
        twice[name] = cat[name].unionByName(cat[name])
    want = lk.project(lk.run_chain(twice, lk.ROOT, flat), [(c, columns[c]) for c in lk.FULL_COLUMNS]).distinct()
    got = lk.lookup_full(twice)
    assert got.columns[:-1] == want.columns and len(got.columns) == 38
    rows = sorted(map(repr, got.drop("clabe_banco_formatted").collect()))
    assert rows == sorted(map(repr, want.collect())) and rows
    assert rows == sorted(map(repr, lk.lookup_full(cat).drop("clabe_banco_formatted").collect()))


def test_positions_come_from_sorted_parts_without_another_shuffle(spark, tmp_path):
    rows = [(i * 37 % 50 if i % 9 else None, f"n{i:04d}") for i in range(1000)]
    t = spark.createDataFrame(rows, "k int, name string")
    for listed, whole in ((pk.ordered_with_position(t, ["k", "name"]), t),
                          (pk.ordered_with_position(t, ["k", "name"], checkpoint_input=False), t),
                          (pk.ordered_with_position(t.where("k < 0"), ["k", "name"]), t.where("k < 0"))):
        assert listed.columns == ["k", "name", "pos"] and dict(listed.dtypes)["pos"] == "bigint"
        assert all(columns == {"_part"} for columns in exchanged(listed))
        got = [(r.k, r.name) for r in sorted(listed.collect(), key=lambda r: r.pos)]
        want = sorted(((r.k, r.name) for r in whole.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        assert got == want
        assert [r.pos for r in sorted(listed.collect(), key=lambda r: r.pos)] == list(range(1, len(want) + 1))


def test_ordinals_shuffle_rows_once_and_search_no_bounds_without_hot_keys(spark, no_broadcast):
    rows = [(i % 500 if i % 500 else None, f"n{i:04d}") for i in range(2000)]
    t = spark.createDataFrame(rows, "k int, name string")
    numbered = pk.number_within_key(t, "k", ["name"])
    assert exchanged(numbered) == [{"_kj"}]
    assert "_bounds" not in numbered._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.k, r.name): r.n_in_key for r in numbered.collect()}
    want = {}
    for k in {r[0] for r in rows}:
        want.update({(k, n): i for i, n in enumerate(sorted(n for j, n in rows if j == k), start=1)})
    assert got == want
    assert pk.number_within_key(t.where("k < 0"), "k", ["name"]).collect() == []


def test_bounds_part_the_rows_evenly(spark, monkeypatch):
    """Also from a sample that is a small part of the rows."""
    monkeypatch.setattr(pk, "MIN_BUCKET_ROWS", 500)
    monkeypatch.setattr(pk, "_ranges", lambda df, num_buckets=None: num_buckets or 10)
    t = spark.range(0, 20_000, 1, 4).selectExpr("id * 7919 % 20000 as k")
    b, n = pk.range_buckets(t, ["k"])
    sizes = [r["count"] for r in b.groupBy("_bucket").count().collect()]
    assert 8 <= n <= 12 and len(sizes) == n and max(sizes) < 2 * 20_000 / 10 + 1_000
    ends = b.groupBy("_bucket").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("_bucket").collect()
    assert all(a.hi < c.lo for a, c in zip(ends, ends[1:]))
