"""Stand-ins: the reference's relational schema and sheet, derived from the
TPC-H-like test tables.

Every table here is a projection (sometimes a filter or union) of a given
parquet table, so each query's work grows with the data. Mapping:

  propuesta / creditos / contratos   <- orders (key = o_orderkey as text)
  contratos_clientes (party links)   <- lineitem (l_orderkey, l_suppkey)
  clientes (parties)                 <- supplier
  caracter_titulares (roles)         <- l_returnflag codes A / R / N
  sucursales (branches)              <- customer (market segment as name)
  vendedor / equipo_vendedores       <- customer / nation
  parcelas / manzana / zonas         <- lineitem line 1 / part / nation / region
  payment methods, addresses, banks  <- supplier, nation, region
  bank code (nullable)               <- o_custkey % 7, null when 0
  sheet                              <- orders (data rows) + nation (banner)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHEET_WIDTH = 24
# Several sheets; two share their file name. An order's sheet is its key % 3.
SHEET_FILES = ("standin://norte/orders.csv", "standin://sur/orders.csv", "standin://sur/otros.csv")
# Sellers and teams that are missing on purpose: their contracts drop out of every
# chain that joins them.
NO_SELLER, NO_TEAM = 3, 20

# The stand-in code tables (small dimensions keyed by the
# code columns of orders / lineitem).
ROLES = [("A", "TITULAR"), ("R", "Propietario"), ("N", "COTITULAR")]
DEBT_STATES = [("F", "CANCELADA"), ("O", "VIGENTE"), ("P", "EN MORA")]
CONTRACT_STATES = [("F", "CERRADO"), ("O", "ACTIVO"), ("P", "SUSPENDIDO")]
PROPOSAL_TYPES = [("F",), ("O",), ("P",)]
# '5-LOW' has no contract type on purpose: such contracts drop out of every
# chain that joins tipos_contratos (an inner join used as a filter).
CONTRACT_TYPES = [("1-URGENT", "CONTADO"), ("2-HIGH", "CREDITO 12"),
                  ("3-MEDIUM", "CREDITO 24"), ("4-NOT SPECIFIED", "CREDITO 36")]


TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "labels", "pages", "benchmark", "conversations")

# DataFrames are immutable plans, so the ones built here are memoized per
# (application, directory): building them costs driver time (file listing,
# footer reads, analysis), not executor work.
_MEMO: dict[tuple, object] = {}


def _memo(kind: str, spark: SparkSession, sf_dir: str, build):
    key = (kind, id(spark), spark.conf.get("spark.app.id", ""), sf_dir)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


class _Tables(dict):
    """Test tables read on first access."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise KeyError(name)
        df = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        self[name] = df
        return df


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _memo("tables", spark, sf_dir, lambda: _Tables(spark, sf_dir))


def catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _memo("catalog", spark, sf_dir, lambda: _catalog(spark, sf_dir))


def _catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = tables(spark, sf_dir)
    o, li, s, c, n, r, p = (t["orders"], t["lineitem"], t["supplier"], t["customer"],
                            t["nation"], t["region"], t["part"])
    code = lambda rows, cols: values_table(spark, rows, cols)
    pay1 = s.filter(F.col("s_acctbal") > 0)
    pay2 = s.filter(F.col("s_acctbal") > 9000)
    medios = (pay1.select(F.col("s_suppkey").alias("cod_medio_cobro"),
                          F.col("s_suppkey").alias("cod_cliente"),
                          F.lit("EFECTIVO").alias("descripcion"),
                          F.col("s_nationkey").alias("cod_cobrador_asignado"),
                          F.col("s_nationkey").alias("cod_zona_cobranza"))
              .unionByName(pay2.select((-F.col("s_suppkey") - 1).alias("cod_medio_cobro"),
                                       F.col("s_suppkey").alias("cod_cliente"),
                                       F.lit("TRANSFERENCIA").alias("descripcion"),
                                       F.col("s_nationkey").alias("cod_cobrador_asignado"),
                                       F.col("s_nationkey").alias("cod_zona_cobranza"))))
    return {
        "propuesta": o.select(F.col("o_orderkey").alias("cod_propuesta"),
                              F.col("o_orderkey").cast("string").alias("legajo"),
                              F.col("o_orderstatus").alias("cod_tipo_propuesta")),
        "creditos": o.select(F.col("o_orderkey").alias("cod_propuesta"),
                             F.col("o_totalprice").cast("decimal(18,2)").alias("monto"),
                             F.col("o_custkey").alias("cod_sucursal"),
                             F.col("o_orderstatus").alias("cod_estado_deuda")),
        "contratos": o.select(F.col("o_orderkey").alias("cod_contrato"),
                              F.col("o_orderkey").alias("cod_propuesta"),
                              F.to_date("o_orderdate").alias("fecha"),
                              F.col("o_orderstatus").alias("cod_estado_contrato"),
                              F.col("o_orderpriority").alias("cod_tipo_contrato"),
                              F.col("o_custkey").alias("cod_vendedor"),
                              F.substring("o_orderpriority", 1, 1).cast("int")
                              .alias("cod_plan_venta_modelo")),
        "contratos_clientes": li.select(F.col("l_suppkey").alias("cod_cliente"),
                                        F.col("l_orderkey").alias("cod_contrato"),
                                        F.col("l_returnflag").alias("cod_caracter_titular")),
        "clientes": s.select(F.col("s_suppkey").alias("cod_cliente"),
                             F.col("s_name").alias("nombre"),
                             F.concat(F.lit("T-"), F.col("s_suppkey")).alias("telefono"),
                             F.concat(F.lit("M-"), F.col("s_suppkey")).alias("telefono_movil"),
                             F.lit(None).cast("string").alias("telefono_laboral"),
                             F.lit("RFC").alias("tipo_documento"),
                             F.col("s_suppkey").cast("string").alias("nro_documento"),
                             F.concat(F.lit("N"), F.col("s_nationkey")).alias("cuit")),
        "caracter_titulares": code(ROLES, "cod_caracter_titular string, nombre string"),
        "sucursales": c.select(F.col("c_custkey").alias("cod_sucursal"),
                               F.col("c_mktsegment").alias("nombre")),
        "estados_deudas": code(DEBT_STATES, "cod_estado_deuda string, estado string"),
        "estados_contratos": code(CONTRACT_STATES, "cod_estado_contrato string, estado string"),
        "tipos_propuestas": code(PROPOSAL_TYPES, "cod_tipo_propuesta string"),
        "tipos_contratos": code(CONTRACT_TYPES, "cod_tipo_contrato string, nombre string"),
        "vendedor": c.filter(F.col("c_custkey") % 11 != NO_SELLER).select(F.col("c_custkey").alias("cod_vendedor"),
                             F.col("c_name").alias("nombre"),
                             F.col("c_nationkey").alias("cod_equipo")),
        "equipo_vendedores": n.filter(F.col("n_nationkey") != NO_TEAM).select(F.col("n_nationkey").alias("cod_equipo"),
                                      F.col("n_name").alias("descripcion")),
        "planes_ventas_modelos": r.select(F.col("r_regionkey").alias("cod_plan_venta_modelo"),
                                          F.col("r_name").alias("nombre")),
        "contratos_parcelas": li.filter(F.col("l_linenumber") == 1)
                                .select(F.col("l_orderkey").alias("cod_contrato_parcela"),
                                        F.col("l_partkey").alias("cod_parcela")),
        "parcela": p.select(F.col("p_partkey").alias("cod_parcela"),
                            F.col("p_name").alias("legajo"),
                            F.col("p_size").alias("cod_estado"),
                            F.col("p_size").alias("cod_manzana")),
        "estados_parcela": r.select(F.col("r_regionkey").alias("cod_estado_parcela")),
        "manzana": n.select(F.col("n_nationkey").alias("cod_manzana"),
                            F.col("n_regionkey").alias("cod_zona_parque")),
        "zonas_parques": r.select(F.col("r_regionkey").alias("cod_zona_parque")),
        "medios_cobros": medios,
        "zona_cobranza": n.select(F.col("n_nationkey").alias("cod_zona_cobranza"),
                                  F.col("n_regionkey").alias("cod_modalidad_cobranza"),
                                  F.col("n_name").alias("descripcion")),
        "medios_cobros_domicilios": medios.select("cod_medio_cobro",
                                                  F.col("cod_cliente").alias("cod_domicilio")),
        "domicilios": s.select(F.col("s_suppkey").alias("cod_domicilio"),
                               F.concat(F.lit("CALLE "), F.col("s_suppkey")).alias("direccion"),
                               F.col("s_nationkey").cast("string").alias("manzana"),
                               F.col("s_nationkey").alias("cod_barrio"),
                               F.col("s_nationkey").alias("cod_localidad")),
        "barrios": n.select(F.col("n_nationkey").alias("cod_barrio"), F.col("n_name").alias("nombre")),
        "localidades": n.select(F.col("n_nationkey").alias("cod_localidad"),
                                F.col("n_name").alias("nombre"),
                                F.col("n_regionkey").alias("cod_provincia")),
        "provincias": r.select(F.col("r_regionkey").alias("cod_provincia"),
                               F.col("r_name").alias("nombre")),
        "tarjeta_oxxo": o.filter(F.col("o_orderstatus") == "P")
                         .select(F.col("o_orderkey").alias("cod_propuesta"),
                                 F.col("o_custkey").alias("cod_usuario_alta"),
                                 F.concat(F.lit("OX"), F.col("o_orderkey")).alias("codigo_barra")),
        "clabe_bancaria": o.select(F.col("o_orderkey").alias("cod_propuesta"),
                                   F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey") % 7)
                                   .cast("decimal(18,0)").alias("clabe")),
        "medios_cobros_bancos": pay1.select(
            F.col("s_suppkey").alias("cod_medio_cobro"),
            F.concat(F.lit("CTA-"), F.col("s_suppkey")).alias("nro_cuenta"),
            F.when(F.col("s_acctbal") > 5000, F.col("s_name")).alias("titular")),
    }


def values_table(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """A small literal table as a SQL ``VALUES`` relation (a LocalRelation
    with exact size statistics, so joins against it are broadcast)."""
    names = [f.strip().split()[0] for f in ddl.split(",")]
    lit = lambda v: "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo("sheet", spark, sf_dir, lambda: _sheet(spark, sf_dir))


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24-column sheets: 10 banner rows each (from nation), then one data row per
    order at row ``o_orderkey / 3 + 11`` of the sheet ``o_orderkey % 3``.

    Column B (c1) holds the key in several shapes: plain, space padded,
    leading zero, null, empty, with a letter, with a dot. Column F (c5) is
    the client cell: null, '', spaces, CLIENTE, nan, None, null, a supplier
    name or another name. H (c7) and I (c8) are date / amount cells, V (c21) is an
    amount cell. M (c12) holds every key plainly: the best key column is past J.
    """
    t = tables(spark, sf_dir)
    o, n = t["orders"], t["nation"]
    k = F.col("o_orderkey").cast("string")
    m10 = F.col("o_orderkey") % 10
    c1 = (F.when(m10 == 4, F.concat(F.lit(" "), k, F.lit(" ")))
          .when(m10 == 5, F.concat(F.lit("0"), k))
          .when(m10 == 6, F.lit(None).cast("string"))
          .when(m10 == 7, F.lit(""))
          .when(m10 == 8, F.concat(k, F.lit("A")))
          .when(m10 == 9, F.concat(F.substring(k, 1, 1), F.lit("."), F.expr("substr(cast(o_orderkey as string), 2)")))
          .otherwise(k))
    m9 = F.col("o_custkey") % 9
    c5 = (F.when(m9 == 0, F.lit(None).cast("string"))
          .when(m9 == 1, F.lit("")).when(m9 == 2, F.lit("  "))
          .when(m9 == 3, F.lit("CLIENTE")).when(m9 == 4, F.lit("nan"))
          .when(m9 == 5, F.lit("None")).when(m9 == 6, F.lit("null"))
          .when(m9 == 7, F.concat(F.lit("Supplier#"),
                                  F.lpad((F.col("o_orderkey") % 100).cast("string"), 9, "0")))
          .otherwise(F.lit("OTRO CLIENTE")))
    date_txt = F.date_format("o_orderdate", "yyyy-MM-dd")
    amount_txt = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    extra = {12: k, 21: F.when(F.col("o_orderkey") % 4 == 0, amount_txt)}
    data = o.select(
        F.element_at(F.array(*map(F.lit, SHEET_FILES)), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("file_path"),
        (F.floor(F.col("o_orderkey") / 3) + 11).cast("long").alias("row_no"),
        (F.col("o_orderkey") + 1).cast("string").alias("c0"),
        c1.alias("c1"), date_txt.alias("c2"), F.col("o_orderpriority").alias("c3"),
        amount_txt.alias("c4"), c5.alias("c5"), F.col("o_orderstatus").alias("c6"),
        F.when(F.col("o_orderkey") % 2 == 1, date_txt).alias("c7"),
        F.when(F.col("o_orderkey") % 3 == 0, amount_txt).alias("c8"),
        *[extra.get(i, F.lit(None).cast("string")).alias(f"c{i}") for i in range(9, SHEET_WIDTH)])
    label = F.col("n_nationkey") == 9
    lab = lambda text: F.when(label, F.lit(text))
    banner = n.filter(F.col("n_nationkey") < 10).select(
        F.explode(F.array(*map(F.lit, SHEET_FILES))).alias("file_path"),
        (F.col("n_nationkey") + 1).cast("long").alias("row_no"),
        F.when(label, F.lit("ORDEN")).otherwise(F.col("n_name")).alias("c0"),
        F.when(label, F.lit("PROPUESTA JKM")).when(F.col("n_nationkey") == 8, F.lit("NUMERO"))
         .otherwise(F.col("n_regionkey").cast("string")).alias("c1"),
        lab("FECHA").alias("c2"), lab("PRIORIDAD").alias("c3"), lab("IMPORTE").alias("c4"),
        lab("CLIENTE").alias("c5"), lab("ESTADO").alias("c6"), lab("FECHA CONTRATO").alias("c7"),
        lab("IMPORTE ORIGINAL").alias("c8"),
        *[F.lit(None).cast("string").alias(f"c{i}") for i in range(9, SHEET_WIDTH)])
    return banner.unionByName(data)


def sheet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in sheet as raw comma-separated text lines, ragged: a
    row's trailing null cells are left out, as a spreadsheet export does."""
    return _memo("lines", spark, sf_dir, lambda: _sheet_lines(spark, sf_dir))


def _sheet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sh = sheet(spark, sf_dir)
    cells = [F.coalesce(F.col(f"c{i}"), F.lit("")) for i in range(SHEET_WIDTH)]
    last = F.greatest(*[F.when(F.col(f"c{i}").isNotNull(), F.lit(i + 1)).otherwise(F.lit(0))
                        for i in range(SHEET_WIDTH)])
    arr = F.slice(F.array(*cells), 1, last)
    return sh.select("file_path", "row_no", F.array_join(arr, ",").alias("value"))
