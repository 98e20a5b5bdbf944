from pyspark.sql import functions as F

from fixtures import catalog
from sheetrecon.operators import lookup as lk
from sheetrecon.operators import pick as pk


def test_core_chain_and_keyset(spark):
    cat = catalog(spark)
    rows = lk.lookup_core(cat).collect()
    assert len(rows) == 10
    keys = spark.createDataFrame([("10153",), (" 500 ",), ("999",)], "key string") \
        .select(F.trim("key").alias("key"))
    sub = lk.lookup_core(cat, keys).collect()
    assert {r.legajo for r in sub} == {"10153", "500"}


def test_priority_pick_roles_case_insensitive(spark):
    cat = catalog(spark)
    picked = {r.legajo: r for r in pk.priority_pick(lk.lookup_role(cat)).collect()}
    # 10153: TITULAR MARTA, Titular ZOE, TITULAR CARLA -> rank 1, by name: CARLA
    assert picked["10153"].nombre_cliente == "CARLA"
    assert picked["116090"].nombre_cliente == "PEDRO"
    assert picked["500"].nombre_cliente is None       # only a PROPIETARIO with null name
    assert len(picked) == 5


def test_filters_drop_contract_missing_dimension(spark):
    cat = catalog(spark)
    with_f = {r.legajo for r in lk.lookup_role(cat, with_filters=True).collect()}
    without = {r.legajo for r in lk.lookup_role(cat).collect()}
    assert "600" in without and "600" not in with_f


def test_at_most_one_row_per_key(spark):
    cat = catalog(spark)
    df = pk.priority_pick(lk.lookup_role(cat))
    assert df.groupBy("legajo").count().filter("count > 1").count() == 0


def test_first_last_per_key(spark):
    cat = catalog(spark)
    rows = lk.lookup_core(cat)
    first = {r.legajo: r.nombre_cliente for r in pk.first_per_key(rows, "legajo", ["nombre_cliente"]).collect()}
    last = {r.legajo: r.nombre_cliente for r in pk.last_per_key(rows, "legajo", ["nombre_cliente"]).collect()}
    assert first["10153"] == "ANA" and last["10153"] == "ZOE"


def test_contact_chain_correlated_in_rewrite(spark):
    cat = catalog(spark)
    rows = lk.lookup_contact(cat).collect()
    by = {}
    for r in rows:
        by.setdefault((r.cod_propuesta, r.nombre_cliente), []).append(r.direccion)
    # MARTA (101) pays by methods 1 and 2 -> addresses 10 (twice, distinct once) and 11
    assert sorted(by[("10153", "MARTA")]) == ["CALLE 1", "CALLE 2"]
    # ZOE has no payment method -> one row with null address
    assert by[("10153", "ZOE")] == [None]
    # 600 lacks its contract type -> dropped by the inner join
    assert all(r.cod_propuesta != "600" for r in rows)


def test_full_chain_bank_code(spark):
    cat = catalog(spark)
    rows = lk.lookup_full(cat).collect()
    fm = {(r.cod_propuesta, r.clabe_banco_formatted) for r in rows}
    assert ("10153", "C.12345678901234") in fm
    assert ("116090", "0") in fm
    assert len(rows[0]) == 38


def test_holder_rows_and_combined_policy(spark):
    cat = catalog(spark)
    h = lk.holder_rows(cat)
    combined = {r.legajo: r.cliente for r in pk.priority_pick_combined(h).collect()}
    # among rank-1 parties of 10153 only MARTA has a bank holder
    assert combined["10153"] == "MARTA"
    n = pk.number_within_key(h, "legajo", ["cliente", "caracter_titular", "titular_cobro"])
    firsts = n.filter("n_in_key = 1").collect()
    assert all(r.key_display == r.legajo for r in firsts)
    assert n.filter("n_in_key > 1 AND key_display != ''").count() == 0


def test_point_lookup(spark):
    cat = catalog(spark)
    r = lk.lookup_by_key(lk.lookup_core(cat), "10153", ["nombre_cliente"]).collect()
    assert len(r) == 1 and r[0].nombre_cliente == "ANA"
    assert lk.lookup_by_key(lk.lookup_core(cat), "nope", ["nombre_cliente"]).count() == 0


def test_merge_and_fallback(spark):
    a = spark.createDataFrame([("1", "A1"), ("2", "A2")], "legajo string, v string")
    b = spark.createDataFrame([("2", "B2"), ("3", "B3")], "legajo string, v string")
    merged = {r.legajo: r.v for r in lk.merge_lookups([a, b]).collect()}
    assert merged == {"1": "A1", "2": "B2", "3": "B3"}
    fb = {r.legajo: (r.v, r._tier) for r in lk.fallback_lookup([a, b]).collect()}
    assert fb == {"1": ("A1", 1), "2": ("A2", 1), "3": ("B3", 2)}


import pytest


@pytest.mark.parametrize("buckets", [1, 6, 64])
def test_global_positions_match_python_sort(spark, buckets):
    import random
    random.seed(7)
    data = [(random.choice(["x", "y", None, "z"]), random.choice([None, *range(50)]), i) for i in range(800)]
    df = spark.createDataFrame(data, "a string, b int, i int")
    got = pk.ordered_with_position(df, ["a", "b", "i"], num_buckets=buckets).collect()
    key = lambda r: ((r[0] is not None, r[0] or ""), (r[1] is not None, r[1] or 0), r[2])
    want = {t[2]: n for n, t in enumerate(sorted(data, key=key), start=1)}
    assert {r.i: r.pos for r in got} == want


def test_hot_key_spreads_over_buckets_and_stays_exact(spark):
    # one key holds a third of all rows
    rows = [("HOT" if i % 3 == 0 else f"k{i % 50}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v long")
    b, nb = pk.range_buckets(df, ["k", "v"], num_buckets=8)
    hot_buckets = {r._bucket for r in b.filter("k = 'HOT'").select("_bucket").distinct().collect()}
    assert len(hot_buckets) >= 2
    n = pk.number_within_key(df, "k", ["v"], checkpoint_input=False).filter("k = 'HOT'")
    assert sorted(r.n_in_key for r in n.collect()) == list(range(1, 1001))
    from sheetrecon.operators.runlog import running_average
    ra = running_average(df.withColumn("x", F.lit(1.0)), "x", ["v"], ["k"]).filter("k = 'HOT'")
    assert {r.running_avg for r in ra.collect()} == {1.0}
    picked = pk.first_per_key(df, "k", ["v"])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert {r.k: r.v for r in picked.collect()}["HOT"] == 0


def test_number_within_key_null_and_hot_keys_across_buckets(spark):
    # a third of the rows share one key, a sixth have no key; many buckets
    rows = [("HOT" if i % 3 == 0 else (None if i % 6 == 1 else f"k{i % 40}"), i % 97, i)
            for i in range(2400)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    got = pk.number_within_key(df, "k", ["v", "i"], checkpoint_input=False).collect()
    assert len(got) == len(rows)
    want = {}
    for k in {r[0] for r in rows}:
        grp = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))
        want.update({r[2]: n for n, r in enumerate(grp, start=1)})
    assert {r.i: r.n_in_key for r in got} == want
    assert all((r.key_display == (r.k if r.n_in_key == 1 else "")) or
               (r.k is None and r.n_in_key == 1) for r in got)


@pytest.mark.parametrize("partition", [[], ["g"]])
def test_running_aggregate_null_group_and_global(spark, partition):
    rows = [("A" if i % 3 == 0 else (None if i % 3 == 1 else "B"), i, float(i % 7)) for i in range(1500)]
    df = spark.createDataFrame(rows, "g string, o int, x double")
    got = {r.o: (r._run_sum, r._run_n)
           for r in pk.running_aggregate(df, "x", ["o"], partition, num_buckets=12).collect()}
    want, acc = {}, {}
    for g, o, x in sorted(rows, key=lambda r: r[1]):
        grp = g if partition else "all"
        s, n = acc.get(grp, (0.0, 0))
        acc[grp] = (s + x, n + 1)
        want[o] = acc[grp]
    assert got == want


def test_pick_and_full_record_have_the_same_keys(spark):
    """Sellers and teams that are missing drop their contracts from both."""
    import os

    from sheetrecon.operators import pick as pk2
    from sheetrecon.plans import standin
    if not os.path.exists("/root/testdata/sf0.001"):
        return
    cat = standin.catalog(spark, "/root/testdata/sf0.001")
    picked = {r.legajo for r in pk2.priority_pick(lk.lookup_role(cat, with_filters=True)).select("legajo").collect()}
    full = {r[0] for r in lk.lookup_full(cat).select("cod_propuesta").distinct().collect()}
    every = {r[0] for r in pk2.priority_pick(lk.lookup_role(cat)).select("legajo").collect()}
    assert picked == full and len(picked) < len(every)


def test_point_lookup_pushes_codes_to_the_fact_scans(spark):
    import os

    from sheetrecon.plans import standin
    if not os.path.exists("/root/testdata/sf0.001"):
        return
    cat = lk.point_catalog(standin.catalog(spark, "/root/testdata/sf0.001"), ["1200"])
    for name in ("contratos", "creditos", "contratos_clientes"):
        plan = cat[name]._jdf.queryExecution().executedPlan().toString()
        assert "orderkey" in plan.split("PushedFilters:")[1].split("]")[0]
