"""DuckDB SQL for the correctness oracle.

Each registered query has an independent ANSI-SQL statement over the raw
test tables. The stand-in schema and sheet (see ``standin.py``) are
re-stated here as SQL CTEs; ``with_ctes`` prepends the ones a statement
uses (with their dependencies).
"""

from __future__ import annotations

from ..functions.symbols import SYMBOL_TEXT, emoji_class

_DEPS: dict[str, tuple[str, ...]] = {}
_CTE: dict[str, str] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    _CTE[name] = sql
    _DEPS[name] = deps


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _DEPS[n]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n{_CTE[n]}\n)" for n in order) + "\n" + body


# ------------------------------------------------------------ stand-in schema
cte("propuesta", "SELECT o_orderkey AS cod_propuesta, CAST(o_orderkey AS VARCHAR) AS legajo, "
    "o_orderstatus AS cod_tipo_propuesta FROM orders")
cte("creditos", "SELECT o_orderkey AS cod_propuesta, CAST(o_totalprice AS DECIMAL(18,2)) AS monto, "
    "o_custkey AS cod_sucursal, o_orderstatus AS cod_estado_deuda FROM orders")
cte("contratos", "SELECT o_orderkey AS cod_contrato, o_orderkey AS cod_propuesta, "
    "CAST(o_orderdate AS DATE) AS fecha, o_orderstatus AS cod_estado_contrato, "
    "o_orderpriority AS cod_tipo_contrato, o_custkey AS cod_vendedor, "
    "CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS cod_plan_venta_modelo FROM orders")
cte("contratos_clientes", "SELECT l_suppkey AS cod_cliente, l_orderkey AS cod_contrato, "
    "l_returnflag AS cod_caracter_titular FROM lineitem")
cte("clientes", "SELECT s_suppkey AS cod_cliente, s_name AS nombre, 'T-' || s_suppkey AS telefono, "
    "'M-' || s_suppkey AS telefono_movil, CAST(NULL AS VARCHAR) AS telefono_laboral, "
    "'RFC' AS tipo_documento, CAST(s_suppkey AS VARCHAR) AS nro_documento, "
    "'N' || s_nationkey AS cuit FROM supplier")
cte("caracter_titulares", "SELECT * FROM (VALUES ('A', 'TITULAR'), ('R', 'Propietario'), "
    "('N', 'COTITULAR')) t(cod_caracter_titular, nombre)")
cte("sucursales", "SELECT c_custkey AS cod_sucursal, c_mktsegment AS nombre FROM customer")
cte("estados_deudas", "SELECT * FROM (VALUES ('F', 'CANCELADA'), ('O', 'VIGENTE'), "
    "('P', 'EN MORA')) t(cod_estado_deuda, estado)")
cte("estados_contratos", "SELECT * FROM (VALUES ('F', 'CERRADO'), ('O', 'ACTIVO'), "
    "('P', 'SUSPENDIDO')) t(cod_estado_contrato, estado)")
cte("tipos_propuestas", "SELECT * FROM (VALUES ('F'), ('O'), ('P')) t(cod_tipo_propuesta)")
cte("tipos_contratos", "SELECT * FROM (VALUES ('1-URGENT', 'CONTADO'), ('2-HIGH', 'CREDITO 12'), "
    "('3-MEDIUM', 'CREDITO 24'), ('4-NOT SPECIFIED', 'CREDITO 36')) t(cod_tipo_contrato, nombre)")
cte("vendedor", "SELECT c_custkey AS cod_vendedor, c_name AS nombre, c_nationkey AS cod_equipo "
    "FROM customer WHERE c_custkey % 11 <> 3")
cte("equipo_vendedores", "SELECT n_nationkey AS cod_equipo, n_name AS descripcion FROM nation "
    "WHERE n_nationkey <> 20")
cte("planes_ventas_modelos", "SELECT r_regionkey AS cod_plan_venta_modelo, r_name AS nombre "
    "FROM region")
cte("contratos_parcelas", "SELECT l_orderkey AS cod_contrato_parcela, l_partkey AS cod_parcela "
    "FROM lineitem WHERE l_linenumber = 1")
cte("parcela", "SELECT p_partkey AS cod_parcela, p_name AS legajo, p_size AS cod_estado, "
    "p_size AS cod_manzana FROM part")
cte("estados_parcela", "SELECT r_regionkey AS cod_estado_parcela FROM region")
cte("manzana", "SELECT n_nationkey AS cod_manzana, n_regionkey AS cod_zona_parque FROM nation")
cte("zonas_parques", "SELECT r_regionkey AS cod_zona_parque FROM region")
cte("medios_cobros",
    "SELECT s_suppkey AS cod_medio_cobro, s_suppkey AS cod_cliente, 'EFECTIVO' AS descripcion, "
    "s_nationkey AS cod_cobrador_asignado, s_nationkey AS cod_zona_cobranza "
    "FROM supplier WHERE s_acctbal > 0 UNION ALL "
    "SELECT -s_suppkey - 1, s_suppkey, 'TRANSFERENCIA', s_nationkey, s_nationkey "
    "FROM supplier WHERE s_acctbal > 9000")
cte("zona_cobranza", "SELECT n_nationkey AS cod_zona_cobranza, n_regionkey AS "
    "cod_modalidad_cobranza, n_name AS descripcion FROM nation")
cte("medios_cobros_domicilios", "SELECT cod_medio_cobro, cod_cliente AS cod_domicilio "
    "FROM medios_cobros", ("medios_cobros",))
cte("domicilios", "SELECT s_suppkey AS cod_domicilio, 'CALLE ' || s_suppkey AS direccion, "
    "CAST(s_nationkey AS VARCHAR) AS manzana, s_nationkey AS cod_barrio, "
    "s_nationkey AS cod_localidad FROM supplier")
cte("barrios", "SELECT n_nationkey AS cod_barrio, n_name AS nombre FROM nation")
cte("localidades", "SELECT n_nationkey AS cod_localidad, n_name AS nombre, "
    "n_regionkey AS cod_provincia FROM nation")
cte("provincias", "SELECT r_regionkey AS cod_provincia, r_name AS nombre FROM region")
cte("tarjeta_oxxo", "SELECT o_orderkey AS cod_propuesta, o_custkey AS cod_usuario_alta, "
    "'OX' || o_orderkey AS codigo_barra FROM orders WHERE o_orderstatus = 'P'")
cte("clabe_bancaria", "SELECT o_orderkey AS cod_propuesta, CAST(CASE WHEN o_custkey % 7 <> 0 "
    "THEN o_custkey % 7 END AS DECIMAL(18,0)) AS clabe FROM orders")
cte("medios_cobros_bancos", "SELECT s_suppkey AS cod_medio_cobro, 'CTA-' || s_suppkey AS "
    "nro_cuenta, CASE WHEN s_acctbal > 5000 THEN s_name END AS titular FROM supplier "
    "WHERE s_acctbal > 0")

# ------------------------------------------------------------ stand-in sheet
W = 24  # columns of the stand-in sheets
_K = "CAST(o_orderkey AS VARCHAR)"
_DATE = "strftime(o_orderdate, '%Y-%m-%d')"
_AMT = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
cte("sheet", f"""
SELECT file_path, CAST(n_nationkey + 1 AS BIGINT) AS row_no,
  CASE WHEN n_nationkey = 9 THEN 'ORDEN' ELSE n_name END AS c0,
  CASE WHEN n_nationkey = 9 THEN 'PROPUESTA JKM' WHEN n_nationkey = 8 THEN 'NUMERO'
       ELSE CAST(n_regionkey AS VARCHAR) END AS c1,
  CASE WHEN n_nationkey = 9 THEN 'FECHA' END AS c2,
  CASE WHEN n_nationkey = 9 THEN 'PRIORIDAD' END AS c3,
  CASE WHEN n_nationkey = 9 THEN 'IMPORTE' END AS c4,
  CASE WHEN n_nationkey = 9 THEN 'CLIENTE' END AS c5,
  CASE WHEN n_nationkey = 9 THEN 'ESTADO' END AS c6,
  CASE WHEN n_nationkey = 9 THEN 'FECHA CONTRATO' END AS c7,
  CASE WHEN n_nationkey = 9 THEN 'IMPORTE ORIGINAL' END AS c8,
  {", ".join(f"CAST(NULL AS VARCHAR) AS c{i}" for i in range(9, W))}
FROM nation, (VALUES ('standin://norte/orders.csv'), ('standin://sur/orders.csv'),
  ('standin://sur/otros.csv')) f(file_path) WHERE n_nationkey < 10
UNION ALL
SELECT CASE o_orderkey % 3 WHEN 0 THEN 'standin://norte/orders.csv'
    WHEN 1 THEN 'standin://sur/orders.csv' ELSE 'standin://sur/otros.csv' END,
  o_orderkey // 3 + 11, CAST(o_orderkey + 1 AS VARCHAR),
  CASE o_orderkey % 10 WHEN 4 THEN ' ' || {_K} || ' ' WHEN 5 THEN '0' || {_K}
       WHEN 6 THEN NULL WHEN 7 THEN '' WHEN 8 THEN {_K} || 'A'
       WHEN 9 THEN substr({_K}, 1, 1) || '.' || substr({_K}, 2) ELSE {_K} END,
  {_DATE}, o_orderpriority, {_AMT},
  CASE o_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN 'CLIENTE'
       WHEN 4 THEN 'nan' WHEN 5 THEN 'None' WHEN 6 THEN 'null'
       WHEN 7 THEN 'Supplier#' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 9, '0')
       ELSE 'OTRO CLIENTE' END,
  o_orderstatus,
  CASE WHEN o_orderkey % 2 = 1 THEN {_DATE} END,
  CASE WHEN o_orderkey % 3 = 0 THEN {_AMT} END,
  {", ".join({12: _K, 21: f"CASE WHEN o_orderkey % 4 = 0 THEN {_AMT} END"}.get(i, "NULL") for i in range(9, W))}
FROM orders""")
_CELLS = [f"c{i}" for i in range(W)]
# Raw text line of each sheet row: cells joined by ',', trailing null cells
# left out (no trailing cell is ever an empty string in this sheet).
cte("lines", "SELECT file_path, row_no, rtrim(concat_ws(',', "
    + ", ".join(f"coalesce({c}, '')" for c in _CELLS) + "), ',') AS value FROM sheet", ("sheet",))
# What the line parse yields: empty (unquoted) cells come back as null.
cte("scan", "SELECT file_path, row_no, " + ", ".join(f"nullif({c}, '') AS {c}" for c in _CELLS)
    + " FROM sheet", ("sheet",))
cte("cells", "SELECT file_path, row_no, col_ix, value FROM (" + " UNION ALL ".join(
    f"SELECT file_path, row_no, {i} AS col_ix, {c} AS value FROM sheet"
    for i, c in enumerate(_CELLS)) + ")", ("sheet",))
cte("keys_strict", "SELECT file_path, row_no, trim(c1) AS key FROM sheet WHERE row_no >= 11 "
    "AND regexp_full_match(trim(c1), '[0-9]{4,}')", ("sheet",))
cte("keys_loose", "SELECT file_path, row_no, trim(c1) AS key FROM sheet WHERE row_no >= 11 "
    "AND length(trim(c1)) > 0", ("sheet",))

# ------------------------------------------------------------ lookups
_CHAIN_CORE = """FROM contratos_clientes cc
JOIN clientes c ON cc.cod_cliente = c.cod_cliente
JOIN contratos ct ON cc.cod_contrato = ct.cod_contrato
JOIN propuesta p ON ct.cod_propuesta = p.cod_propuesta
JOIN creditos cr ON cr.cod_propuesta = p.cod_propuesta
JOIN sucursales s ON cr.cod_sucursal = s.cod_sucursal"""
_CORE_TABLES = ("contratos_clientes", "clientes", "contratos", "propuesta", "creditos", "sucursales")
_ROLE_JOIN = "\nJOIN caracter_titulares cart ON cart.cod_caracter_titular = cc.cod_caracter_titular"
_FILTER_JOINS = """
JOIN estados_deudas ed ON cr.cod_estado_deuda = ed.cod_estado_deuda
JOIN estados_contratos ec ON ct.cod_estado_contrato = ec.cod_estado_contrato
JOIN tipos_propuestas tp ON p.cod_tipo_propuesta = tp.cod_tipo_propuesta
JOIN tipos_contratos tc ON ct.cod_tipo_contrato = tc.cod_tipo_contrato
JOIN vendedor vg ON ct.cod_vendedor = vg.cod_vendedor
JOIN equipo_vendedores eq ON vg.cod_equipo = eq.cod_equipo"""
_FILTER_TABLES = ("estados_deudas", "estados_contratos", "tipos_propuestas", "tipos_contratos",
                  "vendedor", "equipo_vendedores")
_ROLE_COLS = ("trim(p.legajo) AS legajo, c.nombre AS nombre_cliente, cart.nombre AS "
              "caracter_titular, s.nombre AS sucursal, cr.monto, ct.fecha AS fecha_contrato")
cte("core_rows", "SELECT trim(p.legajo) AS legajo, c.nombre AS nombre_cliente, cc.cod_cliente, "
    "s.nombre AS sucursal, cr.monto, ct.fecha AS fecha_contrato\n" + _CHAIN_CORE, _CORE_TABLES)
cte("role_rows", f"SELECT {_ROLE_COLS}\n{_CHAIN_CORE}{_ROLE_JOIN}",
    _CORE_TABLES + ("caracter_titulares",))
cte("role_rows_f", f"SELECT {_ROLE_COLS}\n{_CHAIN_CORE}{_ROLE_JOIN}{_FILTER_JOINS}",
    _CORE_TABLES + ("caracter_titulares",) + _FILTER_TABLES)
RANK = ("CASE WHEN upper(caracter_titular) = 'TITULAR' THEN 1 "
        "WHEN upper(caracter_titular) = 'PROPIETARIO' THEN 2 ELSE 3 END")
PICK_ORDER = (f"{RANK}, nombre_cliente NULLS FIRST, caracter_titular NULLS FIRST, "
              "monto NULLS FIRST, fecha_contrato NULLS FIRST, sucursal NULLS FIRST")
cte("picked_all", "SELECT legajo, nombre_cliente, caracter_titular, sucursal, monto, fecha_contrato "
    f"FROM (SELECT *, row_number() OVER (PARTITION BY legajo ORDER BY {PICK_ORDER}) AS rn "
    "FROM role_rows_f) WHERE rn = 1", ("role_rows_f",))
cte("picked", "SELECT * FROM picked_all WHERE legajo IN (SELECT key FROM keys_strict)",
    ("picked_all", "keys_strict"))
cte("holder_rows", """SELECT DISTINCT trim(p.legajo) AS legajo, c.nombre AS cliente,
  cart.nombre AS caracter_titular, mcb.titular AS titular_cobro, s.nombre AS sucursal, cr.monto
""" + _CHAIN_CORE + _ROLE_JOIN + """
LEFT JOIN medios_cobros mco ON mco.cod_cliente = c.cod_cliente
LEFT JOIN medios_cobros_bancos mcb ON mcb.cod_medio_cobro = mco.cod_medio_cobro""",
    _CORE_TABLES + ("caracter_titulares", "medios_cobros", "medios_cobros_bancos"))
cte("contact_rows", """SELECT DISTINCT trim(p.legajo) AS cod_propuesta, c.nombre AS nombre_cliente,
  cc.cod_cliente, s.nombre AS sucursal, cr.monto, ct.fecha AS fecha_contrato, ec.estado,
  tc.nombre AS tipo_contrato, c.telefono, c.telefono_movil, dom.direccion, vg.nombre AS asesor
""" + _CHAIN_CORE + """
JOIN estados_contratos ec ON ct.cod_estado_contrato = ec.cod_estado_contrato
JOIN tipos_contratos tc ON ct.cod_tipo_contrato = tc.cod_tipo_contrato
JOIN vendedor vg ON ct.cod_vendedor = vg.cod_vendedor
LEFT JOIN medios_cobros_domicilios mcd ON mcd.cod_medio_cobro IN (
    SELECT cod_medio_cobro FROM medios_cobros WHERE cod_cliente = c.cod_cliente)
LEFT JOIN domicilios dom ON dom.cod_domicilio = mcd.cod_domicilio""",
    _CORE_TABLES + ("estados_contratos", "tipos_contratos", "vendedor", "medios_cobros",
                    "medios_cobros_domicilios", "domicilios"))

FULL_SQL = """SELECT DISTINCT trim(p.legajo) AS cod_propuesta, c.nombre AS nombre_cliente,
  cc.cod_cliente, s.nombre AS sucursal, cr.monto, ct.fecha AS fecha_contrato,
  pvm.nombre AS nombre_anterior, cc.cod_contrato, ec.estado AS estado, tc.nombre AS tipo_contrato,
  ed.estado AS estado_credito, eq.descripcion AS equipo, vg.nombre AS asesor,
  cart.nombre AS caracter_titular, c.telefono, c.telefono_movil, c.telefono_laboral,
  pa.legajo AS ubicacion, dom.cod_domicilio AS dir_cliente, mco.descripcion AS medio_cobro,
  mco.cod_cobrador_asignado, zc.cod_modalidad_cobranza, zc.descripcion AS zona_cobranza,
  mcd.cod_domicilio AS codigo_cobro_dom, dom.direccion, bar.nombre AS barrio,
  loc.nombre AS localidad, prv.nombre AS provinca, dom.manzana, tx.cod_usuario_alta,
  tx.codigo_barra AS cod_barra_oxxo, cb.clabe AS clabe_banco, c.tipo_documento,
  c.nro_documento, c.cuit AS rfc1, mcb.nro_cuenta AS medio_cobro_cuenta,
  mcb.titular AS titular_cobro,
  CASE WHEN cb.clabe IS NULL THEN '0' ELSE 'C.' || CAST(cb.clabe AS VARCHAR) END
    AS clabe_banco_formatted
FROM contratos_clientes cc
JOIN clientes c ON cc.cod_cliente = c.cod_cliente
JOIN caracter_titulares cart ON cart.cod_caracter_titular = cc.cod_caracter_titular
JOIN contratos ct ON cc.cod_contrato = ct.cod_contrato
JOIN propuesta p ON ct.cod_propuesta = p.cod_propuesta
JOIN creditos cr ON cr.cod_propuesta = p.cod_propuesta
JOIN sucursales s ON cr.cod_sucursal = s.cod_sucursal
JOIN estados_deudas ed ON cr.cod_estado_deuda = ed.cod_estado_deuda
JOIN estados_contratos ec ON ct.cod_estado_contrato = ec.cod_estado_contrato
JOIN tipos_propuestas tp ON p.cod_tipo_propuesta = tp.cod_tipo_propuesta
LEFT JOIN contratos_parcelas cp ON ct.cod_contrato = cp.cod_contrato_parcela
LEFT JOIN parcela pa ON cp.cod_parcela = pa.cod_parcela
LEFT JOIN estados_parcela ep ON ep.cod_estado_parcela = pa.cod_estado
LEFT JOIN manzana ma ON pa.cod_manzana = ma.cod_manzana
LEFT JOIN zonas_parques zp ON ma.cod_zona_parque = zp.cod_zona_parque
JOIN vendedor vg ON ct.cod_vendedor = vg.cod_vendedor
JOIN equipo_vendedores eq ON vg.cod_equipo = eq.cod_equipo
JOIN tipos_contratos tc ON ct.cod_tipo_contrato = tc.cod_tipo_contrato
LEFT JOIN planes_ventas_modelos pvm ON ct.cod_plan_venta_modelo = pvm.cod_plan_venta_modelo
LEFT JOIN medios_cobros mco ON mco.cod_cliente = c.cod_cliente
LEFT JOIN zona_cobranza zc ON zc.cod_zona_cobranza = mco.cod_zona_cobranza
LEFT JOIN medios_cobros_domicilios mcd ON mcd.cod_medio_cobro = mco.cod_medio_cobro
LEFT JOIN domicilios dom ON dom.cod_domicilio = mcd.cod_domicilio
LEFT JOIN barrios bar ON bar.cod_barrio = dom.cod_barrio
LEFT JOIN localidades loc ON loc.cod_localidad = dom.cod_localidad
LEFT JOIN provincias prv ON prv.cod_provincia = loc.cod_provincia
LEFT JOIN tarjeta_oxxo tx ON tx.cod_propuesta = p.cod_propuesta
LEFT JOIN clabe_bancaria cb ON cb.cod_propuesta = p.cod_propuesta
LEFT JOIN medios_cobros_bancos mcb ON mcb.cod_medio_cobro = mco.cod_medio_cobro"""
FULL_TABLES = (
    "propuesta", "creditos", "contratos", "contratos_clientes", "clientes", "caracter_titulares",
    "sucursales", "estados_deudas", "estados_contratos", "tipos_propuestas", "tipos_contratos",
    "vendedor", "equipo_vendedores", "planes_ventas_modelos", "contratos_parcelas", "parcela",
    "estados_parcela", "manzana", "zonas_parques", "medios_cobros", "zona_cobranza",
    "medios_cobros_domicilios", "domicilios", "barrios", "localidades", "provincias",
    "tarjeta_oxxo", "clabe_bancaria", "medios_cobros_bancos")


def symbols_sql(col: str) -> str:
    """Nested replace() calls + the emoji class, as in ``normalize_symbols``."""
    expr = col
    for sym, text in SYMBOL_TEXT:
        expr = f"replace({expr}, '{sym}', '{text}')"
    return f"regexp_replace({expr}, '{emoji_class()}', '[EMOJI]', 'g')"
