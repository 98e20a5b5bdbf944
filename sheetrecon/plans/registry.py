"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built from the
test tables (through the stand-ins of ``standin.py``); ``ORACLE`` holds the
matching DuckDB SQL. Column names agree between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fmt
from ..functions.symbols import SYMBOL_TEXT, decode_text, normalize_symbols
from ..functions.text import clip, is_fillable
from ..operators import fill as fl
from ..operators import lookup as lk
from ..operators import pick as pk
from ..operators import profile as pr
from ..operators import runlog as rl
from ..sources import records as rc
from ..sources import sheet as sh
from . import oracle as o
from . import standin

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ shared parts
def _cat(spark, d):
    return standin.catalog(spark, d)


def _sheet(spark, d):
    return standin.sheet(spark, d)


def _keys(spark, d):
    return fl.sheet_keys(_sheet(spark, d), "c1", 11, "strict")


def _picked(spark, d):
    """Flagship lookup: one party per sheet key (J4 + dimension filters, W1)."""
    return pk.priority_pick(lk.lookup_role(_cat(spark, d), _keys(spark, d), with_filters=True))


def _picked_all(spark, d):
    return pk.priority_pick(lk.lookup_role(_cat(spark, d), None, with_filters=True))


# ------------------------------------------------------------ sources
@register("sheet_scan", o.with_ctes("SELECT * FROM scan", "scan"))
def sheet_scan(spark, d):
    return sh.parse_lines(standin.sheet_lines(spark, d), standin.SHEET_WIDTH)


@register("null_token_clean", o.with_ctes(
    "SELECT file_path, row_no, " + ", ".join(
        f"CASE WHEN c{i} IN ('', 'NULL', 'null', '#N/D') THEN NULL ELSE c{i} END AS c{i}"
        for i in range(o.W)) + " FROM scan", "scan"))
def null_token_clean(spark, d):
    return sh.clean_null_tokens(sheet_scan(spark, d))


@register("detect_separator", o.with_ctes(
    "SELECT file_path, CASE WHEN contains(value, chr(9)) THEN chr(9) ELSE ',' END AS sep "
    "FROM lines WHERE row_no = 1", "lines"))
def detect_separator(spark, d):
    return sh.detect_separator(standin.sheet_lines(spark, d))


@register("fields_per_line", o.with_ctes(
    "SELECT file_path, row_no, CASE WHEN contains(value, chr(9)) THEN chr(9) ELSE ',' END AS sep, "
    "CAST(CASE WHEN contains(value, chr(9)) THEN len(string_split(value, chr(9))) "
    "ELSE len(string_split(value, ',')) END AS INTEGER) AS n_fields, "
    "substr(value, 1, 80) AS head FROM lines", "lines"))
def fields_per_line(spark, d):
    return sh.fields_per_line(standin.sheet_lines(spark, d))


@register("sheet_preview", o.with_ctes("SELECT * FROM scan WHERE row_no <= 16", "scan"))
def sheet_preview(spark, d):
    return sh.head_rows(sheet_scan(spark, d), 16)


@register("sheet_dims", o.with_ctes(
    "SELECT file_path, count(*) AS total_rows, "
    "CAST(max(len(string_split(value, ','))) AS INTEGER) AS total_cols "
    "FROM lines GROUP BY file_path", "lines"))
def sheet_dims(spark, d):
    return pr.sheet_dims(standin.sheet_lines(spark, d))


@register("sheet_row_numbers", "SELECT o_orderkey + 1 AS row_no, CAST(o_orderkey AS VARCHAR) AS value FROM orders")
def sheet_row_numbers(spark, d):
    """Row numbers from the scan's splits, over a table stored in key order."""
    scan = spark.read.parquet(f"{d}/orders.parquet").select(
        F.col("_metadata.file_path").alias(sh.FILE), F.col("_metadata.file_block_start").alias("_blk"),
        F.col("o_orderkey").cast("string").alias("value"))
    return sh.number_text_scan(scan).select("row_no", "value")


@register("sheet_summary", o.with_ctes(
    "SELECT file_path, total_rows, total_cols, n_keys, key_samples FROM (SELECT file_path, count(*) AS total_rows, "
    "CAST(max(len(string_split(value, ','))) AS INTEGER) AS total_cols FROM lines GROUP BY file_path) "
    "LEFT JOIN (SELECT file_path, count(*) AS n_keys, list(trim(c1) ORDER BY row_no)[1:2] AS key_samples FROM sheet "
    "WHERE row_no BETWEEN 11 AND 13 AND length(trim(c1)) > 0 GROUP BY file_path) USING (file_path)",
    "lines", "sheet"))
def sheet_summary(spark, d):
    """A17."""
    from ..sources.files import sheet_summary as build
    return build(_sheet(spark, d), standin.sheet_lines(spark, d))


# ------------------------------------------------------------ predicates
@register("data_region", o.with_ctes("SELECT * FROM sheet WHERE row_no >= 11", "sheet"))
def data_region(spark, d):
    return sh.data_region(_sheet(spark, d), 11)


@register("extract_keys_strict", o.with_ctes("SELECT * FROM keys_strict", "keys_strict"))
def extract_keys_strict(spark, d):
    return _keys(spark, d)


@register("extract_keys_loose", o.with_ctes("SELECT * FROM keys_loose", "keys_loose"))
def extract_keys_loose(spark, d):
    return fl.sheet_keys(_sheet(spark, d), "c1", 11, "loose")


@register("extract_keys_decimal", o.with_ctes(
    "SELECT file_path, row_no, c1 AS key, replace(c1, '.', '') AS key_digits FROM sheet "
    "WHERE row_no >= 11 AND c1 NOT IN ('', 'PROPUESTA JKM', 'NUMERO') "
    "AND regexp_full_match(replace(c1, '.', ''), '[0-9]+')", "sheet"))
def extract_keys_decimal(spark, d):
    return fl.decimal_keys(_sheet(spark, d), "c1", 11)


@register("fillable_cells", o.with_ctes(
    "SELECT file_path, row_no, c5, (c5 IS NULL OR trim(c5) IN ('', 'CLIENTE', 'nan', 'None', "
    "'null')) AS fillable FROM sheet WHERE row_no >= 11", "sheet"))
def fillable_cells(spark, d):
    s = sh.data_region(_sheet(spark, d), 11)
    return s.select("file_path", "row_no", "c5", is_fillable("c5").alias("fillable"))


@register("key_cell_detail", o.with_ctes(
    "SELECT file_path, row_no, c1 AS value, coalesce(regexp_full_match(c1, '[0-9]+'), false) "
    "AS is_digit, CAST(coalesce(length(c1), 0) AS INTEGER) AS length FROM sheet", "sheet"))
def key_cell_detail(spark, d):
    s = _sheet(spark, d)
    return s.select("file_path", "row_no", F.col("c1").alias("value"),
                    F.coalesce(F.col("c1").rlike(r"\A[0-9]+\z"), F.lit(False)).alias("is_digit"),
                    F.coalesce(F.length("c1"), F.lit(0)).alias("length"))


@register("search_text_cells", o.with_ctes(
    "SELECT file_path, row_no, col_ix, value, chr(65 + col_ix) AS col_letter FROM cells "
    "WHERE value IS NOT NULL AND contains(upper(trim(value)), 'PROPUESTA')", "cells"))
def search_text_cells(spark, d):
    return pr.search_cells(_sheet(spark, d), text="PROPUESTA")


@register("search_numeric_cells", o.with_ctes(
    "SELECT file_path, row_no, col_ix, value, chr(65 + col_ix) AS col_letter FROM cells "
    "WHERE regexp_full_match(trim(value), '[0-9]{4,}')", "cells"))
def search_numeric_cells(spark, d):
    return pr.search_cells(_sheet(spark, d), numeric=True)


@register("find_label_column", o.with_ctes(
    "SELECT f.file_path, l.label, coalesce(m.col_ix, 24) AS col_ix, m.col_ix IS NULL AS appended "
    "FROM (SELECT DISTINCT file_path FROM sheet WHERE row_no = 1) f "
    "CROSS JOIN (VALUES ('CLIENTE'), ('FECHA CONTRATO'), ('TELEFONO')) l(label) "
    "LEFT JOIN (SELECT file_path, value, min(col_ix) AS col_ix FROM cells "
    "WHERE row_no <= 10 GROUP BY file_path, value) m "
    "ON m.file_path = f.file_path AND m.value = l.label", "cells", "sheet"))
def find_label_column(spark, d):
    return pr.find_label_column(_sheet(spark, d), ["CLIENTE", "FECHA CONTRATO", "TELEFONO"])


# ------------------------------------------------------------ lookups
@register("lookup_core", o.with_ctes("SELECT * FROM core_rows", "core_rows"))
def lookup_core(spark, d):
    return lk.lookup_core(_cat(spark, d))


@register("lookup_role", o.with_ctes("SELECT * FROM role_rows", "role_rows"))
def lookup_role(spark, d):
    return lk.lookup_role(_cat(spark, d))


@register("lookup_contact", o.with_ctes("SELECT * FROM contact_rows", "contact_rows"))
def lookup_contact(spark, d):
    return lk.lookup_contact(_cat(spark, d))


@register("lookup_full", o.with_ctes(o.FULL_SQL, *o.FULL_TABLES))
def lookup_full(spark, d):
    return lk.lookup_full(_cat(spark, d))


@register("lookup_by_keyset", o.with_ctes(
    "SELECT * FROM role_rows_f WHERE legajo IN (SELECT key FROM keys_strict)",
    "role_rows_f", "keys_strict"))
def lookup_by_keyset(spark, d):
    return lk.lookup_role(_cat(spark, d), _keys(spark, d), with_filters=True)


@register("lookup_by_key", o.with_ctes(
    "SELECT legajo, nombre_cliente, caracter_titular, sucursal, monto, fecha_contrato FROM ("
    "SELECT *, row_number() OVER (PARTITION BY legajo ORDER BY nombre_cliente NULLS FIRST, "
    "caracter_titular NULLS FIRST, sucursal NULLS FIRST, monto NULLS FIRST, "
    "fecha_contrato NULLS FIRST) AS rn FROM role_rows WHERE legajo IN ('10153', '116090')) "
    "WHERE rn = 1", "role_rows"))
def lookup_by_key(spark, d):
    keys = ["10153", "116090"]
    rows = lk.lookup_role(lk.point_catalog(_cat(spark, d), keys))
    return pk.first_per_key(rows, "legajo", ["nombre_cliente", "caracter_titular", "sucursal", "monto",
                                             "fecha_contrato"])


@register("lookup_probe_or_first", o.with_ctes(
    "SELECT legajo, nombre_cliente, caracter_titular, sucursal, monto, fecha_contrato FROM ("
    "SELECT *, row_number() OVER (PARTITION BY legajo ORDER BY nombre_cliente NULLS FIRST, "
    "caracter_titular NULLS FIRST, sucursal NULLS FIRST, monto NULLS FIRST, "
    "fecha_contrato NULLS FIRST) AS rn FROM role_rows WHERE legajo = coalesce("
    "(SELECT max(legajo) FROM role_rows WHERE legajo = 'NO-EXISTE'), "
    "(SELECT min(legajo) FROM role_rows))) WHERE rn = 1", "role_rows"))
def lookup_probe_or_first(spark, d):
    rows = lk.lookup_role(_cat(spark, d))
    order = ["nombre_cliente", "caracter_titular", "sucursal", "monto", "fecha_contrato"]
    return lk.lookup_by_key_or_first(rows, "NO-EXISTE", order)


@register("amount_filter", o.with_ctes(
    "SELECT trim(p.legajo) AS legajo, cr.monto FROM creditos cr JOIN propuesta p "
    "ON cr.cod_propuesta = p.cod_propuesta WHERE cr.monto > 1500", "creditos", "propuesta"))
def amount_filter(spark, d):
    c = _cat(spark, d)
    j = lk.run_chain(c, ("cr", "creditos"), (lk.Link("p", "propuesta", (("cr.cod_propuesta", "cod_propuesta"),)),))
    return lk.project(j.filter(F.col("cr__monto") > 1500), [("legajo", lk.key_text("p.legajo")), ("monto", "cr.monto")])


@register("holder_report", o.with_ctes(
    "SELECT legajo, n_in_key, CASE WHEN n_in_key = 1 THEN legajo ELSE '' END AS key_display, "
    "CASE WHEN length(substr(cliente, 1, 28)) > 0 THEN substr(cliente, 1, 28) ELSE 'N/A' END AS cliente, "
    "coalesce(nullif(caracter_titular, ''), 'NULL') AS caracter_titular, "
    "coalesce(nullif(titular_cobro, ''), 'NULL') AS titular_cobro, "
    "CASE WHEN length(substr(sucursal, 1, 13)) > 0 THEN substr(sucursal, 1, 13) ELSE 'N/A' END AS sucursal, "
    "CASE WHEN monto IS NULL OR monto = 0 THEN '0' ELSE format('{:,.0f}', round_even(monto, 0)) END AS monto "
    "FROM (SELECT *, row_number() OVER (PARTITION BY legajo ORDER BY cliente NULLS FIRST, "
    "caracter_titular NULLS FIRST, titular_cobro NULLS FIRST, sucursal NULLS FIRST, "
    "monto NULLS FIRST) AS n_in_key FROM holder_rows)", "holder_rows"))
def holder_report(spark, d):
    rows = lk.holder_rows(_cat(spark, d))
    n = pk.number_within_key(rows, "legajo",
                             ["cliente", "caracter_titular", "titular_cobro", "sucursal", "monto"])
    return n.select(
        "legajo", "n_in_key", "key_display",
        fmt.label_or("cliente", "N/A", 28).alias("cliente"),
        fmt.label_or("caracter_titular", "NULL").alias("caracter_titular"),
        fmt.label_or("titular_cobro", "NULL").alias("titular_cobro"),
        fmt.label_or("sucursal", "N/A", 13).alias("sucursal"),
        F.when(F.col("monto").isNull() | (F.col("monto") == 0), F.lit("0"))
         .otherwise(fmt.thousands("monto", 0)).alias("monto"))


# ------------------------------------------------------------ picks and orders
@register("priority_pick", o.with_ctes("SELECT * FROM picked_all", "picked_all"))
def priority_pick(spark, d):
    return _picked_all(spark, d)


@register("priority_pick_combined", o.with_ctes(
    "SELECT legajo, cliente, caracter_titular, titular_cobro, sucursal, monto FROM ("
    f"SELECT *, row_number() OVER (PARTITION BY legajo ORDER BY {o.RANK}, "
    "CASE WHEN titular_cobro IS NULL THEN 1 ELSE 0 END, cliente NULLS FIRST, "
    "caracter_titular NULLS FIRST, titular_cobro NULLS FIRST, sucursal NULLS FIRST, "
    "monto NULLS FIRST) AS rn FROM holder_rows) WHERE rn = 1", "holder_rows"))
def priority_pick_combined(spark, d):
    return pk.priority_pick_combined(lk.holder_rows(_cat(spark, d)))


_FIRST_ORDER = "nombre_cliente NULLS FIRST, cod_cliente NULLS FIRST, sucursal NULLS FIRST, monto NULLS FIRST, fecha_contrato NULLS FIRST"


@register("first_per_key", o.with_ctes(
    "SELECT legajo, nombre_cliente, cod_cliente, sucursal, monto, fecha_contrato FROM ("
    f"SELECT *, row_number() OVER (PARTITION BY legajo ORDER BY {_FIRST_ORDER}) AS rn "
    "FROM core_rows) WHERE rn = 1", "core_rows"))
def first_per_key(spark, d):
    return pk.first_per_key(lk.lookup_core(_cat(spark, d)), "legajo",
                            ["nombre_cliente", "cod_cliente", "sucursal", "monto", "fecha_contrato"])


@register("last_per_key", o.with_ctes(
    "SELECT legajo, nombre_cliente, cod_cliente, sucursal, monto, fecha_contrato FROM ("
    "SELECT *, row_number() OVER (PARTITION BY legajo ORDER BY nombre_cliente DESC NULLS LAST, "
    "cod_cliente DESC NULLS LAST, sucursal DESC NULLS LAST, monto DESC NULLS LAST, "
    "fecha_contrato DESC NULLS LAST) AS rn FROM core_rows) WHERE rn = 1", "core_rows"))
def last_per_key(spark, d):
    return pk.last_per_key(lk.lookup_core(_cat(spark, d)), "legajo",
                           ["nombre_cliente", "cod_cliente", "sucursal", "monto", "fecha_contrato"])


@register("lookup_ordered", o.with_ctes(
    "SELECT *, row_number() OVER (ORDER BY legajo NULLS FIRST, nombre_cliente NULLS FIRST, "
    "cod_cliente NULLS FIRST, sucursal NULLS FIRST, monto NULLS FIRST, fecha_contrato NULLS FIRST) "
    "AS pos FROM core_rows", "core_rows"))
def lookup_ordered(spark, d):
    return pk.ordered_with_position(
        lk.lookup_core(_cat(spark, d)),
        ["legajo", "nombre_cliente", "cod_cliente", "sucursal", "monto", "fecha_contrato"])


@register("priority_order", o.with_ctes(
    f"SELECT *, row_number() OVER (ORDER BY legajo NULLS FIRST, {o.PICK_ORDER}) AS pos "
    "FROM role_rows", "role_rows"))
def priority_order(spark, d):
    rows = lk.lookup_role(_cat(spark, d))
    return pk.ordered_with_position(
        rows, [F.col("legajo"), pk.role_rank("caracter_titular"), F.col("nombre_cliente"),
               F.col("caracter_titular"), F.col("monto"), F.col("fecha_contrato"), F.col("sucursal")])


@register("first_keys", o.with_ctes(
    "SELECT legajo, row_number() OVER (ORDER BY legajo) AS pos FROM propuesta "
    "ORDER BY legajo LIMIT 10", "propuesta"))
def first_keys(spark, d):
    p = _cat(spark, d)["propuesta"].select("legajo")
    top = p.orderBy("legajo").limit(10)
    return pk.small_ordinal(top, ["legajo"])


@register("holder_sample", o.with_ctes(
    "SELECT titular, row_number() OVER (ORDER BY titular) AS pos FROM ("
    "SELECT DISTINCT titular FROM medios_cobros_bancos WHERE titular IS NOT NULL "
    "ORDER BY titular LIMIT 20)", "medios_cobros_bancos"))
def holder_sample(spark, d):
    b = _cat(spark, d)["medios_cobros_bancos"]
    top = b.filter(F.col("titular").isNotNull()).select("titular").distinct().orderBy("titular").limit(20)
    return pk.small_ordinal(top, ["titular"])


@register("role_values", o.with_ctes(
    "SELECT nombre, row_number() OVER (ORDER BY nombre) AS pos FROM ("
    "SELECT DISTINCT nombre FROM caracter_titulares)", "caracter_titulares"))
def role_values(spark, d):
    return pk.small_ordinal(_cat(spark, d)["caracter_titulares"].select("nombre").distinct(), ["nombre"])


@register("role_usage", o.with_ctes(
    "SELECT cart.nombre, count(cc.cod_contrato) AS n_links FROM caracter_titulares cart LEFT JOIN "
    "contratos_clientes cc ON cart.cod_caracter_titular = cc.cod_caracter_titular GROUP BY cart.nombre",
    "contratos_clientes", "caracter_titulares"))
def role_usage(spark, d):
    """Links per role name, unused roles too: the links are counted by code first."""
    c = _cat(spark, d)
    used = c["contratos_clientes"].groupBy("cod_caracter_titular").agg(F.count("cod_contrato").alias("n"))
    return (c["caracter_titulares"].join(used, "cod_caracter_titular", "left")
            .groupBy("nombre").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_links")))


@register("distinct_parties", o.with_ctes(
    "SELECT DISTINCT legajo, nombre_cliente FROM core_rows", "core_rows"))
def distinct_parties(spark, d):
    return lk.lookup_core(_cat(spark, d)).select("legajo", "nombre_cliente").distinct()


@register("merge_lookups", o.with_ctes(
    "SELECT legajo, nombre_cliente, caracter_titular, sucursal, monto, fecha_contrato "
    "FROM picked_all UNION ALL "
    "SELECT legajo, nombre_cliente, NULL, sucursal, monto, fecha_contrato FROM ("
    f"SELECT *, row_number() OVER (PARTITION BY legajo ORDER BY {_FIRST_ORDER}) AS rn "
    "FROM core_rows) WHERE rn = 1 AND legajo NOT IN (SELECT legajo FROM picked_all)",
    "picked_all", "core_rows"))
def merge_lookups(spark, d):
    c = _cat(spark, d)
    tier1 = pk.first_per_key(lk.lookup_core(c), "legajo",
                             ["nombre_cliente", "cod_cliente", "sucursal", "monto", "fecha_contrato"]) \
        .drop("cod_cliente")
    tier2 = _picked_all(spark, d)
    return lk.merge_lookups([tier1, tier2]).select(
        "legajo", "nombre_cliente", "caracter_titular", "sucursal", "monto", "fecha_contrato")


@register("fallback_lookup", o.with_ctes(
    "SELECT legajo, nombre_cliente, caracter_titular, sucursal, monto, fecha_contrato, 1 AS tier "
    "FROM picked_all UNION ALL "
    "SELECT legajo, nombre_cliente, caracter_titular, NULL, NULL, NULL, 2 FROM ("
    f"SELECT *, row_number() OVER (PARTITION BY legajo ORDER BY {o.PICK_ORDER}) AS rn "
    "FROM role_rows) WHERE rn = 1 AND legajo NOT IN (SELECT legajo FROM picked_all)",
    "picked_all", "role_rows"))
def fallback_lookup(spark, d):
    c = _cat(spark, d)
    tier1 = _picked_all(spark, d)
    tier2 = pk.priority_pick(lk.lookup_role(c)).select("legajo", "nombre_cliente", "caracter_titular")
    out = lk.fallback_lookup([tier1, tier2])
    return out.select("legajo", "nombre_cliente", "caracter_titular", "sucursal", "monto",
                      "fecha_contrato", F.col("_tier").alias("tier"))


# ------------------------------------------------------------ membership and fills
@register("matched_keys", o.with_ctes(
    "SELECT * FROM keys_strict WHERE key IN (SELECT legajo FROM picked)", "keys_strict", "picked"))
def matched_keys(spark, d):
    return fl.matched_keys(_keys(spark, d), _picked(spark, d))


_UNMATCHED_SQL = ("SELECT file_path, row_no, key, 'No se encontró datos para propuesta: ' || key "
                  "AS message FROM keys_strict WHERE key NOT IN (SELECT legajo FROM picked)")


@register("unmatched_keys", o.with_ctes(_UNMATCHED_SQL, "keys_strict", "picked"))
def unmatched_keys(spark, d):
    return fl.unmatched_keys(_keys(spark, d), _picked(spark, d))


@register("unmatched_sample", o.with_ctes(
    "SELECT pos, file_path, row_no, message, greatest(total - 3, 0) AS more FROM ("
    "SELECT file_path, row_no, message, row_number() OVER (ORDER BY file_path, row_no) AS pos, "
    "count(*) OVER () AS total "
    f"FROM ({_UNMATCHED_SQL})) WHERE pos <= 3", "keys_strict", "picked"))
def unmatched_sample(spark, d):
    return fl.unmatched_sample(fl.unmatched_keys(_keys(spark, d), _picked(spark, d)), 3)


_FILL_BASE = """SELECT s.*, p.legajo IS NOT NULL AS matched, p.nombre_cliente AS v,
  p.caracter_titular AS role, p.monto AS v_monto, p.fecha_contrato AS v_fecha,
  (s.c5 IS NULL OR trim(s.c5) IN ('', 'CLIENTE', 'nan', 'None', 'null')) AS fillable
FROM sheet s LEFT JOIN picked p ON s.row_no >= 11 AND trim(s.c1) = p.legajo"""
o.cte("fill_base", _FILL_BASE, ("sheet", "picked"))


_REST = ", ".join(f"c{i}" for i in range(6, o.W))
_LAST = ", ".join(f"c{i}" for i in range(9, o.W))


def _fill_sql(overwrite: bool) -> str:
    action = ("CASE WHEN row_no < 11 THEN NULL WHEN NOT matched THEN 'unmatched' "
              "WHEN fillable THEN 'newly_filled' WHEN trim(c5) IS NOT DISTINCT FROM v "
              f"THEN 'already_filled' WHEN {str(overwrite).upper()} THEN 'overwritten' "
              "ELSE 'already_filled' END")
    return (f"SELECT file_path, row_no, c0, c1, c2, c3, c4, "
            f"CASE WHEN a IN ('newly_filled', 'overwritten') THEN v ELSE c5 END AS c5, "
            f"{_REST}, a AS fill_action FROM (SELECT *, {action} AS a FROM fill_base)")


@register("fill_blank_only", o.with_ctes(_fill_sql(False), "fill_base"))
def fill_blank_only(spark, d):
    return fl.fill_column(_sheet(spark, d), _picked(spark, d), overwrite=False)


@register("fill_overwrite", o.with_ctes(_fill_sql(True), "fill_base"))
def fill_overwrite(spark, d):
    return fl.fill_column(_sheet(spark, d), _picked(spark, d), overwrite=True)


_MULTI_SQL = f"""SELECT file_path, row_no, c0, c1, c2, c3, c4,
  CASE WHEN go THEN v ELSE c5 END AS c5, c6,
  CASE WHEN go THEN strftime(v_fecha, '%Y-%m-%d') ELSE c7 END AS c7,
  CASE WHEN go THEN CAST(v_monto AS VARCHAR) ELSE c8 END AS c8, {_LAST},
  go AS filled, go AND coalesce(contains(upper(role), 'TITULAR'), false) AS is_holder
FROM (SELECT *, matched AND fillable AND row_no >= 11 AS go FROM fill_base)"""
o.cte("fill_multi_rows", _MULTI_SQL, ("fill_base",))
_MULTI_TARGETS = {"c5": "nombre_cliente", "c7": "fecha_contrato", "c8": "monto"}


def _fill_multi(spark, d):
    return fl.fill_gated(_sheet(spark, d), _picked(spark, d), _MULTI_TARGETS)


@register("fill_multi", o.with_ctes("SELECT * FROM fill_multi_rows", "fill_multi_rows"))
def fill_multi(spark, d):
    return _fill_multi(spark, d)


@register("fill_always", o.with_ctes(
    "SELECT s.file_path, s.row_no, s.c0, s.c1, s.c2, s.c3, s.c4, "
    "CASE WHEN l.cod_propuesta IS NOT NULL THEN l.nombre_cliente ELSE s.c5 END AS c5, "
    "s." + _REST.replace(" c", " s.c") + ", l.cod_propuesta IS NOT NULL AS matched FROM sheet s LEFT JOIN ("
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cod_propuesta ORDER BY "
    "nombre_cliente DESC NULLS LAST, cod_cliente DESC NULLS LAST, sucursal DESC NULLS LAST, "
    "monto DESC NULLS LAST, fecha_contrato DESC NULLS LAST, estado DESC NULLS LAST, "
    "tipo_contrato DESC NULLS LAST, telefono DESC NULLS LAST, telefono_movil DESC NULLS LAST, "
    "direccion DESC NULLS LAST, asesor DESC NULLS LAST) AS rn FROM contact_rows) WHERE rn = 1"
    ") l ON s.row_no >= 11 AND trim(s.c1) = l.cod_propuesta", "sheet", "contact_rows"))
def fill_always(spark, d):
    rows = lk.lookup_contact(_cat(spark, d))
    last = pk.last_per_key(rows, "cod_propuesta", [c for c in rows.columns if c != "cod_propuesta"])
    return fl.fill_always(_sheet(spark, d), last, key_col="cod_propuesta")


# ------------------------------------------------------------ statistics
_STATS_SQL = """SELECT
  (SELECT count(*) FROM keys_strict) AS total_legajos,
  (SELECT count(DISTINCT key) FROM keys_strict) AS distinct_legajos,
  (SELECT count(DISTINCT key) FROM keys_strict WHERE key IN (SELECT legajo FROM picked)) AS found_in_db,
  count(*) FILTER (WHERE a = 'already_filled') AS already_filled,
  count(*) FILTER (WHERE a = 'newly_filled') AS newly_filled,
  count(*) FILTER (WHERE a = 'overwritten') AS overwritten
FROM (SELECT fill_action AS a FROM ({fill}))"""


def _rates_sql(inner: str) -> str:
    def r(num, den):
        return f"round(coalesce(({num}) * 100.0 / nullif({den}, 0), 0.0), 1)"
    return ("SELECT total_legajos, distinct_legajos, found_in_db, already_filled, newly_filled, "
            f"overwritten, {r('found_in_db', 'total_legajos')} AS efficiency_pct, "
            f"{r('found_in_db', 'distinct_legajos')} AS distinct_efficiency_pct, "
            f"{r('newly_filled + already_filled + overwritten', 'total_legajos')} AS fill_pct "
            f"FROM ({inner})")


@register("fill_stats", o.with_ctes(_rates_sql(_STATS_SQL.format(fill=_fill_sql(True))),
                                    "fill_base", "keys_strict"))
def fill_stats(spark, d):
    filled = fl.fill_column(_sheet(spark, d), _picked(spark, d), overwrite=True)
    return fl.fill_stats(filled)


@register("coverage_rates", o.with_ctes(
    "SELECT efficiency_pct, distinct_efficiency_pct, fill_pct FROM ("
    + _rates_sql(_STATS_SQL.format(fill=_fill_sql(False))) + ")", "fill_base", "keys_strict"))
def coverage_rates(spark, d):
    filled = fl.fill_column(_sheet(spark, d), _picked(spark, d), overwrite=False)
    return fl.fill_stats(filled).select(
        "efficiency_pct", "distinct_efficiency_pct", "fill_pct")


@register("holder_count", o.with_ctes(
    "SELECT count(*) FILTER (WHERE filled) AS updated, count(*) FILTER (WHERE is_holder) AS holders, "
    "round(coalesce(count(*) FILTER (WHERE is_holder) * 100.0 / "
    "nullif(count(*) FILTER (WHERE filled), 0), 0.0), 1) AS holder_pct FROM fill_multi_rows",
    "fill_multi_rows"))
def holder_count(spark, d):
    return fl.holder_stats(_fill_multi(spark, d))


@register("batch_counts", o.with_ctes(
    "SELECT batch, count(*) AS n_keys, count(DISTINCT CASE WHEN hit THEN key END) AS n_matched FROM ("
    "SELECT key, CAST(floor((row_number() OVER (ORDER BY file_path, row_no) - 1) / 100) AS BIGINT) + 1 AS batch, "
    "key IN (SELECT legajo FROM picked) AS hit FROM keys_strict) GROUP BY batch",
    "keys_strict", "picked"))
def batch_counts(spark, d):
    return fl.batch_counts(_keys(spark, d), _picked(spark, d), 100)


@register("run_summary", o.with_ctes(
    "SELECT true AS success, count(*) AS processed_count, count(*) FILTER (WHERE hit) AS matched_count, "
    "count(*) FILTER (WHERE NOT hit) AS error_count, min_by('No se encontró datos para propuesta: ' || key, "
    "row_no) FILTER (WHERE NOT hit) AS first_error, file_path, CAST(NULL AS DOUBLE) AS execution_time "
    "FROM (SELECT *, key IN (SELECT cod_propuesta FROM contact_rows) AS hit FROM keys_loose) "
    "GROUP BY file_path", "keys_loose", "contact_rows"))
def run_summary(spark, d):
    keys = fl.sheet_keys(_sheet(spark, d), "c1", 11, "loose")
    rows = lk.lookup_contact(_cat(spark, d)).select(F.col("cod_propuesta").alias("legajo"))
    return rl.run_summary(keys, rows)


# ------------------------------------------------------------ profile
_EMPTY_ROW = " + ".join(f"CAST(c{i} IS NULL OR trim(c{i}) = '' AS INTEGER)" for i in range(o.W))


@register("quality_score", o.with_ctes(
    "SELECT file_path, empty_cells, rows_seen, empty_pct, quality_score, CASE "
    "WHEN quality_score >= 90 THEN 'Excelente' WHEN quality_score >= 70 THEN 'Buena' "
    "WHEN quality_score >= 50 THEN 'Regular' ELSE 'Necesita revisión' END AS quality_level FROM ("
    "SELECT *, round(greatest(0.0, 100.0 - empty_pct), 4) AS quality_score FROM ("
    "SELECT file_path, CAST(sum(" + _EMPTY_ROW + ") AS BIGINT) AS empty_cells, count(*) AS rows_seen, "
    "round(sum(" + _EMPTY_ROW + ") * 100.0 / (count(*) * 24), 4) AS empty_pct "
    "FROM sheet GROUP BY file_path))", "sheet"))
def quality_score(spark, d):
    return pr.quality(_sheet(spark, d))


_NN_ROW = " + ".join(f"CAST(c{i} IS NOT NULL AS INTEGER)" for i in range(o.W))


@register("ragged_check", o.with_ctes(
    "SELECT file_path, count(DISTINCT " + _NN_ROW + ") AS distinct_widths, count(*) AS n_rows, "
    "count(*) > 10 AND count(DISTINCT " + _NN_ROW + ") > 2 AS ragged FROM sheet GROUP BY file_path",
    "sheet"))
def ragged_check(spark, d):
    return pr.ragged_check(_sheet(spark, d))


@register("key_profile", o.with_ctes(
    "SELECT a.file_path, a.valid, a.empty, b.sample_values FROM ("
    "SELECT file_path, count(*) FILTER (WHERE length(trim(c1)) > 0) AS valid, "
    "count(*) FILTER (WHERE NOT coalesce(length(trim(c1)) > 0, false)) AS empty "
    "FROM sheet WHERE row_no >= 11 GROUP BY file_path) a LEFT JOIN ("
    "SELECT file_path, list(v ORDER BY row_no) AS sample_values FROM ("
    "SELECT file_path, row_no, trim(c1) AS v, row_number() OVER (PARTITION BY file_path "
    "ORDER BY row_no) AS n FROM sheet WHERE row_no >= 11 AND length(trim(c1)) > 0) "
    "WHERE n <= 5 GROUP BY file_path) b ON a.file_path = b.file_path", "sheet"))
def key_profile(spark, d):
    return pr.key_profile(_sheet(spark, d))


@register("score_key_columns", o.with_ctes(
    "SELECT file_path, col_ix, n_keys, rank, chr(65 + col_ix) AS col_letter, rank = 1 AS is_best FROM ("
    "SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY n_keys DESC, col_ix) AS rank FROM ("
    "SELECT file_path, col_ix, count(*) AS n_keys FROM cells WHERE row_no >= 10 "
    "AND regexp_full_match(trim(value), '[0-9]{4,}') GROUP BY file_path, col_ix))", "cells"))
def score_key_columns(spark, d):
    return pr.score_key_columns(_sheet(spark, d))


@register("cells_by_column", o.with_ctes(
    "SELECT file_path, row_no, col_ix, value, pos, greatest(total - 10, 0) AS more FROM ("
    "SELECT file_path, row_no, col_ix, trim(value) AS value, row_number() OVER (PARTITION BY "
    "file_path, col_ix ORDER BY row_no) AS pos, count(*) OVER (PARTITION BY file_path, col_ix) "
    "AS total FROM cells WHERE regexp_full_match(trim(value), '[0-9]{4,}')) "
    "WHERE pos <= 10", "cells"))
def cells_by_column(spark, d):
    return pr.cells_by_column(_sheet(spark, d))


@register("special_char_check", o.with_ctes(
    "SELECT file_path, count(*) FILTER (WHERE regexp_matches(c1, '[\"\\r\\n]')) AS n_special, "
    "count(*) FILTER (WHERE regexp_matches(c1, '[\"\\r\\n]')) > 0 AS has_special "
    "FROM (SELECT file_path, row_no, CASE row_no % 5 WHEN 1 THEN c1 || chr(34) WHEN 2 THEN c1 || chr(10) "
    "WHEN 3 THEN chr(13) || c1 ELSE c1 END AS c1 FROM sheet) WHERE row_no >= 11 GROUP BY file_path", "sheet"))
def special_char_check(spark, d):
    """Key cells of which some hold a quote, an LF or a CR."""
    m = F.col("row_no") % 5
    cell = (F.when(m == 1, F.concat("c1", F.lit('"'))).when(m == 2, F.concat("c1", F.lit("\n")))
            .when(m == 3, F.concat(F.lit("\r"), "c1")).otherwise(F.col("c1")))
    return pr.special_chars(_sheet(spark, d).withColumn("c1", cell))


@register("preview_clip", o.with_ctes(
    "SELECT file_path, row_no, " + ", ".join(
        f"CASE WHEN length(coalesce(c{i}, '')) > 20 THEN substr(c{i}, 1, 20) || '...' "
        f"ELSE coalesce(c{i}, '') END AS {chr(65 + i)}" for i in range(o.W)) + " FROM sheet", "sheet"))
def preview_clip(spark, d):
    s = _sheet(spark, d)
    return s.select("file_path", "row_no", *[clip(f"c{i}", 20).alias(chr(65 + i)) for i in range(o.W)])


# ------------------------------------------------------------ catalog checks
_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
           "documents", "embeddings", "labels", "pages", "benchmark", "conversations"]


@register("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _TABLES))
def table_counts(spark, d):
    t = standin.tables(spark, d)
    parts = [t[n].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n in _TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_CHECK_TABLES = {"orders": "o_orderkey", "customer": "c_custkey", "supplier": "s_suppkey",
                 "part": "p_partkey", "lineitem": "l_orderkey", "region": "r_regionkey",
                 "nation": "n_nationkey", "events": "event_id", "documents": "doc_id",
                 "embeddings": "vec_id", "labels": "doc_id", "pages": "page_id",
                 "benchmark": "item_id", "conversations": "conv_id"}


@register("check_summary", "SELECT count(*) FILTER (WHERE ok) AS passed, "
          "count(*) FILTER (WHERE NOT ok) AS failed, count(*) AS total, "
          "count(*) FILTER (WHERE NOT ok) = 0 AS all_ok FROM (" + " UNION ALL ".join(
              f"SELECT ok FROM (SELECT count(*) AS n, count({k}) AS nn, count(DISTINCT {k}) AS nd "
              f"FROM {t}), LATERAL (VALUES (n > 0), (nn = n), (nd = nn)) v(ok)"
              for t, k in _CHECK_TABLES.items()) + ")")
def check_summary(spark, d):
    t = standin.tables(spark, d)
    checks = rl.table_checks({n: (t[n], k) for n, k in _CHECK_TABLES.items()})
    return rl.check_summary(checks)


# ------------------------------------------------------------ run log (events)
def _run_log(spark, d):
    ev = standin.tables(spark, d)["events"]
    return ev.select("event_id", "user_id", "ts", "event_type",
                     F.col("value").alias("execution_time"),
                     F.get_json_object("props", "$.k").cast("long").alias("records"),
                     (F.col("event_type") != "error").alias("success"))


@register("run_log_totals", "SELECT count(*) AS runs, "
          "CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total_records, "
          "count(*) FILTER (WHERE event_type = 'error') AS errors, "
          "sum(CAST(value AS DECIMAL(18,2))) AS total_seconds, "
          "round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS avg_seconds, "
          "round(CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS DOUBLE) / "
          "nullif(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 0), 6) AS records_per_sec "
          "FROM events")
def run_log_totals(spark, d):
    return rl.run_log_totals(_run_log(spark, d))


@register("run_log_running_avg", "SELECT event_id, user_id, ts, value AS execution_time, "
          "round(CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w, 6) "
          "AS running_avg FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
def run_log_running_avg(spark, d):
    log = _run_log(spark, d).select("event_id", "user_id", "ts", "execution_time")
    return rl.running_average(log, "execution_time", ["ts", "event_id"], ["user_id"])


# ------------------------------------------------------------ scalar functions
@register("classify_messages", "SELECT doc_id, CASE "
          "WHEN contains(lower(text), 'network request to host') THEN "
          "'Verificar que el servicio de Firebird esté ejecutándose y el puerto 3050 esté abierto' "
          "WHEN contains(lower(text), 'no such file or directory') THEN "
          "'Verificar la ruta del archivo .fdb en DATABASE_CONFIG' "
          "WHEN contains(lower(text), 'your user name and password') THEN "
          "'Verificar usuario y contraseña en DATABASE_CONFIG' "
          "WHEN contains(lower(text), 'connection timeout') THEN "
          "'Verificar conectividad de red al servidor Firebird' "
          "ELSE 'Revisar configuración de Firebird y permisos de archivo' END AS suggestion "
          "FROM (SELECT doc_id, text || CASE doc_id % 7 WHEN 1 THEN ' Network request to HOST x' "
          "WHEN 2 THEN ' No such file or directory' WHEN 3 THEN ' Your user name and password' "
          "WHEN 4 THEN ' connection timeout' WHEN 5 THEN ' connection timeout: no such file or directory' "
          "ELSE '' END AS text FROM documents)")
def classify_messages(spark, d):
    """Document texts that end in an error phrase (none for two in seven)."""
    docs = standin.tables(spark, d)["documents"]
    ends = {1: " Network request to HOST x", 2: " No such file or directory", 3: " Your user name and password",
            4: " connection timeout", 5: " connection timeout: no such file or directory"}
    tail = F.lit("")
    for m, text in ends.items():
        tail = F.when(F.col("doc_id") % 7 == m, F.lit(text)).otherwise(tail)
    return docs.select("doc_id", fmt.classify_message(F.concat("text", tail)).alias("suggestion"))


@register("bank_code_format", o.with_ctes(
    "SELECT trim(p.legajo) AS legajo, cb.clabe, CASE WHEN cb.clabe IS NULL THEN '0' "
    "ELSE 'C.' || CAST(cb.clabe AS VARCHAR) END AS clabe_formatted FROM clabe_bancaria cb "
    "JOIN propuesta p ON p.cod_propuesta = cb.cod_propuesta", "clabe_bancaria", "propuesta"))
def bank_code_format(spark, d):
    c = _cat(spark, d)
    j = lk.run_chain(c, ("cb", "clabe_bancaria"),
                     (lk.Link("p", "propuesta", (("cb.cod_propuesta", "cod_propuesta"),)),))
    return lk.project(j, [("legajo", lk.key_text("p.legajo")), ("clabe", "cb.clabe"),
                          ("clabe_formatted", fmt.bank_code(F.col("cb__clabe")))])


@register("null_to_blank", o.with_ctes(
    "SELECT cod_propuesta, coalesce(nombre_cliente, '') AS nombre_cliente, "
    "CASE WHEN cod_cliente IS NULL OR cod_cliente = 0 THEN '' ELSE CAST(cod_cliente AS VARCHAR) END "
    "AS cod_cliente, coalesce(sucursal, '') AS sucursal, "
    "coalesce(CAST(monto AS DOUBLE), 0.0) AS monto, "
    "coalesce(CAST(fecha_contrato AS VARCHAR), '') AS fecha_contrato, coalesce(estado, '') AS estado, "
    "coalesce(tipo_contrato, '') AS tipo_contrato, coalesce(telefono, '') AS telefono, "
    "coalesce(telefono_movil, '') AS telefono_movil, coalesce(direccion, '') AS direccion, "
    "coalesce(asesor, '') AS asesor FROM contact_rows", "contact_rows"))
def null_to_blank(spark, d):
    rows = lk.lookup_contact(_cat(spark, d))
    out = [F.col("cod_propuesta")]
    for c in rows.columns[1:]:
        if c == "monto":
            out.append(fmt.zero_if_falsy(c).alias(c))
        elif c == "fecha_contrato":
            out.append(F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("")).alias(c))
        else:
            out.append(fmt.blank_if_falsy(c).alias(c))
    return rows.select(*out)


@register("format_amounts", o.with_ctes(
    "SELECT trim(p.legajo) AS legajo, format('{:,.0f}', round_even(cr.monto, 0)) AS monto_0, "
    "format('{:,.2f}', cr.monto) AS monto_2 FROM creditos cr JOIN propuesta p "
    "ON p.cod_propuesta = cr.cod_propuesta", "creditos", "propuesta"))
def format_amounts(spark, d):
    c = _cat(spark, d)
    j = lk.run_chain(c, ("cr", "creditos"),
                     (lk.Link("p", "propuesta", (("cr.cod_propuesta", "cod_propuesta"),)),))
    return lk.project(j, [("legajo", lk.key_text("p.legajo")),
                          ("monto_0", fmt.thousands(F.col("cr__monto"), 0)),
                          ("monto_2", fmt.thousands(F.col("cr__monto"), 2))])


# sizes that reach every tier: a document stands for 1, 10,000 or 100,000 of its like
_SCALE = "CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 10000 ELSE 100000 END"
_SIZE_MB = "n_chars / 1048576.0"


def _scaled_docs(spark, d):
    docs = standin.tables(spark, d)["documents"]
    times = F.when(F.col("doc_id") % 3 == 0, 1).when(F.col("doc_id") % 3 == 1, 10000).otherwise(100000)
    return docs.select("doc_id", (F.col("n_chars") * times).alias("n_chars"))


@register("size_strategy", "SELECT doc_id, CASE WHEN s > 100 THEN 'streaming' WHEN s > 10 THEN "
          "'chunked' ELSE 'standard' END AS strategy, CASE WHEN s > 100 THEN 5000 WHEN s > 10 "
          "THEN 10000 ELSE n_chars END AS chunk_size, round(CASE WHEN s > 100 THEN s * 0.3 "
          "WHEN s > 10 THEN s * 0.8 ELSE s * 1.5 END, 1) AS memory_estimate_mb FROM ("
          f"SELECT doc_id, n_chars, {_SIZE_MB} AS s FROM (SELECT doc_id, n_chars * {_SCALE} AS n_chars "
          "FROM documents))")
def size_strategy(spark, d):
    docs = _scaled_docs(spark, d)
    st = fmt.size_strategy(F.col("n_chars") / 1048576.0, F.col("n_chars"))
    return docs.select("doc_id", st.alias("s")).select("doc_id", "s.*")


@register("time_estimate", "SELECT doc_id, n_chars / 3000.0 AS estimated_seconds, "
          "n_chars / 3000.0 / 60 AS estimated_minutes, CASE "
          "WHEN n_chars / 3000.0 < 60 THEN CAST(CAST(round_even(n_chars / 3000.0, 0) AS BIGINT) "
          "AS VARCHAR) || ' segundos' "
          "WHEN n_chars / 3000.0 < 3600 THEN format('{:,.1f}', round_even(n_chars / 3000.0 / 60, 1)) "
          "|| ' minutos' ELSE format('{:,.1f}', round_even(n_chars / 3000.0 / 3600, 1)) || ' horas' "
          f"END AS human_readable FROM (SELECT doc_id, n_chars * {_SCALE} AS n_chars FROM documents)")
def time_estimate(spark, d):
    docs = _scaled_docs(spark, d)
    return docs.select("doc_id", fmt.time_estimate("n_chars").alias("t")).select("doc_id", "t.*")


_SYMBOLS = "".join(sym for sym, _ in SYMBOL_TEXT)
_MARKED = f"CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN '{_SYMBOLS}' || text ELSE text || '\U0001F995\U0001F9A9' END"


@register("normalize_symbols", f"SELECT doc_id, {o.symbols_sql('text')} AS text FROM "
          f"(SELECT doc_id, {_MARKED} AS text FROM documents)")
def normalize_symbols_q(spark, d):
    """Texts without symbols, with every mapped one, and with other emoji."""
    docs = standin.tables(spark, d)["documents"]
    m = F.col("doc_id") % 3
    text = (F.when(m == 0, F.col("text")).when(m == 1, F.concat(F.lit(_SYMBOLS), "text"))
            .otherwise(F.concat("text", F.lit("\U0001F995\U0001F9A9"))))
    return docs.select("doc_id", normalize_symbols(text).alias("text"))


_LATIN = "regexp_replace(text, '[^\\x{0}-\\x{FF}]', '?', 'g')"


def _latin_bytes(text):
    """ISO-8859-1 bytes of a text; what the encoding lacks is a question mark."""
    return F.encode(F.regexp_replace(text, "[^\\x{0}-\\x{FF}]", "?"), "ISO-8859-1")


@register("decode_text", f"SELECT doc_id, CASE doc_id % 3 WHEN 2 THEN {_LATIN} ELSE text END AS text FROM documents")
def decode_text_q(spark, d):
    """Bytes of the texts: plain UTF-8, with a byte-order mark, and Latin-1."""
    docs = standin.tables(spark, d)["documents"]
    m = F.col("doc_id") % 3
    raw = (F.when(m == 0, F.col("text").cast("binary"))
           .when(m == 1, F.concat(F.lit("\ufeff").cast("binary"), F.col("text").cast("binary")))
           .otherwise(_latin_bytes(F.col("text"))))
    return docs.select("doc_id", decode_text(raw).alias("text"))


@register("decode_files", "SELECT source || '/' || (doc_id // 500) AS file_path, doc_id || ' ' || "
          f"CASE WHEN doc_id // 500 % 2 = 1 THEN {_LATIN} ELSE text END AS value FROM documents")
def decode_files(spark, d):
    """C17 with S1: files of texts, every other one in ISO-8859-1, the rest in UTF-8; the
    encoding is decided for each file from all its bytes."""
    docs = standin.tables(spark, d)["documents"]
    file = F.expr("doc_id div 500")
    raw = F.when(file % 2 == 1, _latin_bytes(F.col("text"))).otherwise(F.col("text").cast("binary"))
    lines = docs.select(F.concat("source", F.lit("/"), file.cast("string")).alias(sh.FILE),
                        F.expr("doc_id div 50").alias("_blk"), F.col("doc_id").alias("_id"),
                        F.concat(F.concat(F.col("doc_id").cast("string"), F.lit(" ")).cast("binary"), raw)
                        .cast("string").alias("value"))
    return rc.numbered(lines).select(sh.FILE, "value")


@register("sheet_records", "SELECT source || '/' || (doc_id // 500) AS file_path, row_number() OVER "
          "(PARTITION BY source || '/' || (doc_id // 500) ORDER BY doc_id) AS row_no, "
          "CAST(doc_id AS VARCHAR) AS c0, text AS c1 FROM documents")
def sheet_records(spark, d):
    """Documents as records of two cells, the text quoted over all its lines; the files
    are cut into splits of 300 lines."""
    docs = standin.tables(spark, d)["documents"]
    record = F.concat(F.col("doc_id").cast("string"), F.lit(',"'), F.replace("text", F.lit('"'), F.lit('""')),
                      F.lit('"'))
    file = F.concat("source", F.lit("/"), F.expr("doc_id div 500").cast("string"))
    lines = docs.select(file.alias(sh.FILE), "doc_id", F.posexplode(F.split(record, "\n", -1)).alias("pos", "value"))
    nth = F.row_number().over(Window.partitionBy(sh.FILE).orderBy("doc_id", "pos")).cast("long")
    lines = lines.withColumn("_id", nth).withColumn("_blk", F.expr("(_id - 1) div 300"))
    return sh.sheet_of(lines.select(sh.FILE, "_blk", "_id", "value"), 2, max_lines=1_000_000)


@register("processed_paths", "SELECT page_id, regexp_extract(p, '[^/]*$') AS name, "
          "regexp_replace(p, '\\.csv$', '_processed.csv') AS processed FROM (SELECT page_id, "
          "CASE WHEN page_id % 2 = 0 THEN url || '/sheet.csv' ELSE url END AS p FROM pages)")
def processed_paths(spark, d):
    pages = standin.tables(spark, d)["pages"]
    p = F.when(F.col("page_id") % 2 == 0, F.concat("url", F.lit("/sheet.csv"))).otherwise(F.col("url"))
    return pages.select("page_id", fmt.basename(p).alias("name"), fmt.processed_path(p).alias("processed"))


@register("extract_keys_window", o.with_ctes("SELECT * FROM keys_strict WHERE row_no <= 60", "keys_strict"))
def extract_keys_window(spark, d):
    """The scan window as the caller's parameter (the feature)."""
    return fl.sheet_keys(_sheet(spark, d), "c1", 11, "strict", end_row=60)


_PROFILE_SQL = """
SELECT st.file_path, st.size_bytes / 1048576.0 AS mb, st.total_rows, st.total_cols,
  q.quality_score, q.quality_level, q.empty_pct, coalesce(k.valid, 0) AS valid,
  coalesce(k.empty, 0) AS empty, coalesce(k.sample_values, []) AS sample_values,
  list_filter([CASE WHEN rg.ragged THEN '[WARNING] Inconsistencia en número de columnas por fila' END,
               CASE WHEN sc.n_special > 0 THEN '[WARNING] Caracteres especiales detectados en columna B' END],
              lambda x: x IS NOT NULL) AS issues
FROM (SELECT file_path, sum(octet_length(encode(value)) + 1) AS size_bytes, count(*) AS total_rows,
             max(len(string_split(value, ','))) AS total_cols FROM lines GROUP BY file_path) st
JOIN (SELECT file_path, empty_pct, round(greatest(0.0, 100.0 - empty_pct), 4) AS quality_score,
             CASE WHEN round(greatest(0.0, 100.0 - empty_pct), 4) >= 90 THEN 'Excelente'
                  WHEN round(greatest(0.0, 100.0 - empty_pct), 4) >= 70 THEN 'Buena'
                  WHEN round(greatest(0.0, 100.0 - empty_pct), 4) >= 50 THEN 'Regular'
                  ELSE 'Necesita revisión' END AS quality_level
      FROM (SELECT file_path, round(sum(EMPTYROW) * 100.0 / (count(*) * 24), 4) AS empty_pct
            FROM sheet GROUP BY file_path)) q ON q.file_path = st.file_path
LEFT JOIN (SELECT a.file_path, a.valid, a.empty, b.sample_values FROM (
      SELECT file_path, count(*) FILTER (WHERE length(trim(c1)) > 0) AS valid,
             count(*) FILTER (WHERE NOT coalesce(length(trim(c1)) > 0, false)) AS empty
      FROM sheet WHERE row_no >= 11 GROUP BY file_path) a LEFT JOIN (
      SELECT file_path, list(v ORDER BY row_no) AS sample_values FROM (
        SELECT file_path, row_no, trim(c1) AS v, row_number() OVER (PARTITION BY file_path
               ORDER BY row_no) AS n FROM sheet WHERE row_no >= 11 AND length(trim(c1)) > 0)
      WHERE n <= 5 GROUP BY file_path) b ON a.file_path = b.file_path) k ON k.file_path = st.file_path
JOIN (SELECT file_path, count(*) > 10 AND count(DISTINCT NNROW) > 2 AS ragged
      FROM sheet GROUP BY file_path) rg ON rg.file_path = st.file_path
LEFT JOIN (SELECT file_path, count(*) FILTER (WHERE regexp_matches(c1, '["\r\n]')) AS n_special
      FROM sheet WHERE row_no >= 11 GROUP BY file_path) sc ON sc.file_path = st.file_path
""".replace("EMPTYROW", _EMPTY_ROW).replace("NNROW", _NN_ROW)


def _f1_sql(x: str) -> str:
    return f"format('{{:.1f}}', round_even(CAST({x} AS DOUBLE), 1))"


_SECS = "total_rows / 3000.0"
_STRAT = ("CASE WHEN mb > 100 THEN 'streaming' WHEN mb > 10 THEN 'chunked' ELSE 'standard' END")
_MEM = "round(CASE WHEN mb > 100 THEN mb * 0.3 WHEN mb > 10 THEN mb * 0.8 ELSE mb * 1.5 END, 1)"
_HUMAN = (f"CASE WHEN {_SECS} < 60 THEN CAST(CAST(round_even({_SECS}, 0) AS BIGINT) AS VARCHAR) || ' segundos' "
          f"WHEN {_SECS} < 3600 THEN format('{{:,.1f}}', round_even({_SECS} / 60, 1)) || ' minutos' "
          f"ELSE format('{{:,.1f}}', round_even({_SECS} / 3600, 1)) || ' horas' END")


@register("profile_report", o.with_ctes(
    "SELECT file_path, array_to_string(list_concat(["
    "'REPORTE DE ANALISIS: ' || regexp_extract(file_path, '[^/]*$'), "
    f"'Tamano: ' || {_f1_sql('mb')} || ' MB', "
    "'Dimensiones: ' || format('{:,}', total_rows) || ' filas x ' || total_cols || ' columnas', "
    "'Claves validas: ' || valid || ', vacias: ' || empty || ', ejemplos: ' || "
    "array_to_string(sample_values[1:3], ', '), "
    f"'Calidad: ' || {_f1_sql('quality_score')} || '/100 (' || quality_level || '), celdas vacias: ' || "
    f"{_f1_sql('empty_pct')} || '%', "
    f"'Estrategia: ' || upper(substr({_STRAT}, 1, 1)) || substr({_STRAT}, 2) || "
    f"', memoria estimada: ' || {_f1_sql(_MEM)} || ' MB', "
    f"'Tiempo estimado: ' || {_HUMAN}], issues), chr(10)) AS report FROM ({_PROFILE_SQL})",
    "sheet", "lines"))
def profile_report(spark, d):
    from ..operators.report import profile_report as build
    return build(_sheet(spark, d), standin.sheet_lines(spark, d))
