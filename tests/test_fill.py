import os
import tempfile

from fixtures import catalog
from sheetrecon.operators import fill as fl
from sheetrecon.operators import lookup as lk
from sheetrecon.operators import pick as pk
from sheetrecon.plans.pipeline import FillRequest, fill_sheet

CELLS = [None, "", "  ", "CLIENTE", "nan", "None", "null", "CARLA", "OTRA"]


def _sheet(spark):
    banner = [("f", i, "BANNER", "PROPUESTA JKM" if i == 10 else None, None, None, None,
               "CLIENTE" if i == 10 else None, None, None) for i in range(1, 11)]
    keys = ["10153", " 116090 ", "500", "999", "0123", "10153", "abc", None, "10153"]
    data = [("f", 11 + i, str(i), k, None, None, None, CELLS[i], None, None)
            for i, k in enumerate(keys)]
    schema = "file_path string, row_no long, " + ", ".join(f"c{i} string" for i in range(8))
    return spark.createDataFrame(banner + data, schema)


def _picked(spark):
    return pk.priority_pick(lk.lookup_role(catalog(spark)))


def test_fill_blank_only_and_actions(spark):
    s = _sheet(spark)
    out = {r.row_no: r for r in fl.fill_column(s, _picked(spark)).collect()}
    assert out[11].c5 == "CARLA" and out[11].fill_action == "newly_filled"     # null cell
    assert out[12].c5 == "PEDRO" and out[12].fill_action == "newly_filled"     # '' cell, padded key
    assert out[13].c5 is None and out[13].fill_action == "newly_filled"        # null party name
    assert out[14].fill_action == "unmatched" and out[14].c5 == "CLIENTE"
    assert out[15].fill_action == "unmatched"                                  # leading zero
    assert out[16].c5 == "CARLA" and out[16].fill_action == "newly_filled"     # 'None' token
    assert out[19].c5 == "OTRA" and out[19].fill_action == "already_filled"
    assert all(out[i].fill_action is None and out[i].c5 == (None if i != 10 else "CLIENTE")
               for i in range(1, 11))


def test_fill_overwrite(spark):
    s = _sheet(spark)
    out = {r.row_no: r for r in fl.fill_column(s, _picked(spark), overwrite=True).collect()}
    assert out[19].c5 == "CARLA" and out[19].fill_action == "overwritten"


def test_fill_changes_only_gated_cells(spark):
    s = _sheet(spark)
    before = {r.row_no: r.asDict() for r in s.collect()}
    after = fl.fill_column(s, _picked(spark)).collect()
    for r in after:
        d = r.asDict()
        for c in ("c0", "c1", "c2", "c3", "c4", "c6", "c7"):
            assert d[c] == before[r.row_no][c]
        if d["fill_action"] not in ("newly_filled", "overwritten"):
            assert d["c5"] == before[r.row_no]["c5"]


def test_gated_multi_fill_and_holders(spark):
    s = _sheet(spark)
    df = fl.fill_gated(s, _picked(spark), {"c5": "nombre_cliente", "c6": "monto", "c7": "fecha_contrato"})
    out = {r.row_no: r for r in df.collect()}
    assert out[11].c5 == "CARLA" and out[11].c6 == "1500.50" and out[11].c7 == "2024-01-05"
    assert out[11].filled and out[11].is_holder
    assert out[13].filled and not out[13].is_holder      # PROPIETARIO
    assert not out[19].filled and out[19].c6 is None
    stats = fl.holder_stats(df).first()
    assert stats.updated == sum(1 for r in out.values() if r.filled)


def test_fill_always_and_membership(spark):
    s = _sheet(spark)
    keys = fl.sheet_keys(s, predicate="loose")
    picked = _picked(spark)
    m, u = fl.matched_keys(keys, picked), fl.unmatched_keys(keys, picked)
    assert m.count() + u.count() == keys.count()
    assert {r.message for r in u.collect()} >= {"No se encontró datos para propuesta: 999"}
    out = {r.row_no: r for r in fl.fill_always(s, picked).collect()}
    assert out[19].c5 == "CARLA" and out[19].matched
    assert not out[14].matched and out[14].c5 == "CLIENTE"


def test_fill_stats_rates(spark):
    s = _sheet(spark)
    picked = _picked(spark)
    st = fl.fill_stats(fl.fill_column(s, picked)).first()
    assert st.total_legajos == 5          # strict keys: 10153 x3, 116090, 0123
    assert st.distinct_legajos == 3
    assert st.found_in_db == 2
    assert st.efficiency_pct == 40.0
    assert st.distinct_efficiency_pct == round(2 * 100 / 3, 1)


def test_pipeline_end_to_end(spark):
    s = _sheet(spark)
    out = fill_sheet(s, catalog(spark), FillRequest(targets={"c5": "nombre_cliente", "c7": "fecha_contrato"},
                                                     dimension_filters=False))
    rows = {r.row_no: r for r in out.collect()}
    assert rows[11].c5 == "CARLA" and rows[11].c7 == "2024-01-05"
    assert out.count() == s.count()


def test_scan_window_and_decimal_first_n(spark):
    s = _sheet(spark)
    win = fl.sheet_keys(s, predicate="loose", end_row=13).collect()
    assert sorted(r.row_no for r in win) == [11, 12, 13]
    dec = fl.decimal_keys(s, first_n=2).collect()
    assert [r.row_no for r in sorted(dec, key=lambda r: r.row_no)] == [11, 13]


def test_small_frame_filters(spark):
    fr1 = spark.createDataFrame([("P1", "ANA", 1000), ("P2", "LUIS", 2000), ("P3", "EVA", 3000)],
                                "propuesta string, cliente string, monto int")
    assert fr1.filter("monto > 1500").count() == 2
    fr2 = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "A int, B string")
    assert [r.B for r in fr2.filter("A > 1").select("B").orderBy("B").collect()] == ["b", "c"]


def test_process_request_path(spark):
    from sheetrecon.plans.pipeline import ProcessRequest, process_sheet
    s = _sheet(spark)
    filled, result, unmatched = process_sheet(s, catalog(spark), ProcessRequest("CLIENTE", 11, "B"))
    r = result.first()
    assert r.success and r.first_error.startswith("No se encontró datos para propuesta: ")
    assert (r.processed_count, r.matched_count, r.error_count) == (8, 5, 3)   # 999, 0123, abc
    rows = {x.row_no: x for x in filled.collect()}
    assert rows[11].c5 == "ZOE" and rows[19].c5 == "ZOE"      # last by name among 10153's parties
    assert rows[14].c5 == "CLIENTE"                            # 999 unmatched
    stage = os.path.join(tempfile.mkdtemp(prefix="sheetrecon-test-"), "stage")
    staged = process_sheet(s, catalog(spark), ProcessRequest("CLIENTE", 11, "B"), stage)
    for one, two in zip((filled, result, unmatched), staged):
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    f2, _, _ = process_sheet(s, catalog(spark), ProcessRequest("H", 11, "B"))
    assert "c7" in f2.columns
    f3, _, _ = process_sheet(s, catalog(spark), ProcessRequest("NUEVA", 11, "c1"))
    assert "c8" in f3.columns


def test_missing_target_cell_is_an_error(spark):
    import pytest
    from sheetrecon.plans.pipeline import FillRequest, fill_sheet
    with pytest.raises(ValueError):
        fill_sheet(_sheet(spark), catalog(spark), FillRequest(targets={"c21": "monto"}))


def test_batches_and_samples_follow_file_and_row(spark):
    from sheetrecon.operators import fill as fl
    rows = [(f, i, f"{f}{i}") for f in ("a", "b") for i in (11, 12, 13)]
    hit = spark.createDataFrame([("a11",), ("a12",), ("b13",)], "legajo string")
    for order in (rows, rows[::-1]):
        keys = spark.createDataFrame(order, "file_path string, row_no long, key string")
        got = {r.batch: r.n_matched for r in fl.batch_counts(keys, hit, 2).collect()}
        assert got == {1: 2, 2: 0, 3: 1}
        s = fl.unmatched_sample(fl.unmatched_keys(keys, hit), 2).orderBy("pos").collect()
        assert [(r.file_path, r.row_no, r.more) for r in s] == [("a", 13, 1), ("b", 11, 1)]
