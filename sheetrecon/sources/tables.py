"""Relational sources (S8): the lookup schema as DataFrames.

Production reads the database over JDBC; tests use parquet. Either way the
result is a ``catalog``: table name -> DataFrame, which every lookup chain
takes. Column names are lower-cased so chains can refer to them uniformly.

JDBC reads are parallel when a numeric ``partition_column`` with bounds is
given (one query per slice), and only the columns a chain uses are fetched:
Spark prunes the SELECT list and pushes simple filters into the WHERE.
Credentials are passed by the caller (from its secret store); nothing here
reads them from the environment.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Tables of the widest lookup (the 29-table chain).
SCHEMA_TABLES = (
    "contratos_clientes", "clientes", "caracter_titulares", "contratos", "propuesta", "creditos",
    "sucursales", "estados_deudas", "estados_contratos", "tipos_propuestas", "contratos_parcelas",
    "parcela", "estados_parcela", "manzana", "zonas_parques", "vendedor", "equipo_vendedores",
    "tipos_contratos", "planes_ventas_modelos", "medios_cobros", "zona_cobranza",
    "medios_cobros_domicilios", "domicilios", "barrios", "localidades", "provincias",
    "tarjeta_oxxo", "clabe_bancaria", "medios_cobros_bancos",
)


#: Tables that grow with the business: never read by one task.
FACT_TABLES = ("propuesta", "contratos", "creditos", "contratos_clientes", "clientes", "contratos_parcelas",
               "medios_cobros", "medios_cobros_domicilios", "domicilios", "tarjeta_oxxo", "clabe_bancaria",
               "medios_cobros_bancos")
#: How the sheet's keys reach the facts: (table, its column, table and column the codes come from).
KEY_PATHS = (
    ("propuesta", "legajo", None),
    ("contratos", "cod_propuesta", ("propuesta", "cod_propuesta")),
    ("creditos", "cod_propuesta", ("propuesta", "cod_propuesta")),
    ("tarjeta_oxxo", "cod_propuesta", ("propuesta", "cod_propuesta")),
    ("clabe_bancaria", "cod_propuesta", ("propuesta", "cod_propuesta")),
    ("contratos_clientes", "cod_contrato", ("contratos", "cod_contrato")),
    ("contratos_parcelas", "cod_contrato_parcela", ("contratos", "cod_contrato")),
    ("clientes", "cod_cliente", ("contratos_clientes", "cod_cliente")),
    ("medios_cobros", "cod_cliente", ("contratos_clientes", "cod_cliente")),
    ("medios_cobros_domicilios", "cod_medio_cobro", ("medios_cobros", "cod_medio_cobro")),
    ("medios_cobros_bancos", "cod_medio_cobro", ("medios_cobros", "cod_medio_cobro")),
    ("domicilios", "cod_domicilio", ("medios_cobros_domicilios", "cod_domicilio")),
)
#: Bucket columns of a co-located catalog; the contract links carry their proposal code there.
BUCKETS = {"propuesta": "cod_propuesta", "contratos": "cod_propuesta", "creditos": "cod_propuesta",
           "tarjeta_oxxo": "cod_propuesta", "clabe_bancaria": "cod_propuesta",
           "contratos_clientes": "cod_propuesta", "contratos_parcelas": "cod_propuesta",
           "clientes": "cod_cliente", "medios_cobros": "cod_cliente"}
CONTRACT_LINKS = {"contratos_clientes": "cod_contrato", "contratos_parcelas": "cod_contrato_parcela"}


@dataclass(frozen=True)
class Partitioning:
    column: str
    lower: int
    upper: int
    num_partitions: int


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def jdbc_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
               partitioning: Partitioning | None = None, fetchsize: int = 10000) -> DataFrame:
    """One table over JDBC (``properties``: user, password, driver, ...)."""
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", fetchsize))
    for k, v in properties.items():
        r = r.option(k, v)
    if partitioning:
        r = (r.option("partitionColumn", partitioning.column)
             .option("lowerBound", partitioning.lower).option("upperBound", partitioning.upper)
             .option("numPartitions", partitioning.num_partitions))
    return lower_columns(r.load())


def jdbc_catalog(spark: SparkSession, url: str, properties: Mapping[str, str],
                 tables: Iterable[str] = SCHEMA_TABLES,
                 partitioning: Mapping[str, Partitioning] | None = None) -> dict[str, DataFrame]:
    """The lookup schema over JDBC, one DataFrame per table (lazy). A fact table
    needs a partitioning: without one a single task would read all of it. To read
    only the rows of a sheet's keys, see ``keyed_catalog``."""
    partitioning = partitioning or {}
    whole = [t for t in tables if t in FACT_TABLES and t not in partitioning]
    if whole:
        raise ValueError(f"fact tables without a partitioning would be read by one task: {', '.join(whole)}")
    return {t: jdbc_table(spark, url, t.upper(), properties, partitioning.get(t)) for t in tables}


def key_predicates(keys: DataFrame, column: str, reads: int, max_in: int = 1000) -> list[str]:
    """One WHERE clause for each of up to ``reads`` parallel reads of a table: the first
    column of ``keys`` as IN lists of up to ``max_in`` literals, or, where there are more
    keys, as disjoint ranges from a range partitioning of the keys. No key: one clause that
    no row meets.

    A range also lets rows between its keys through, so an exact semi join must follow.
    Text keys have to be ASCII digits: equality and order of other texts depend on the
    database's collation, and a row could meet two reads. The driver holds at most
    ``reads * max_in`` keys, or a row per read.
    """
    name = keys.columns[0]
    is_text = keys.schema[0].dataType.simpleString() == "string"
    rows = keys.select(F.trim(name).alias("key") if is_text else F.col(f"`{name}`").cast("decimal(38,0)").alias("key"))
    rows = rows.where("key is not null").distinct()
    bad = F.count_if(~F.col("key").rlike("^[0-9]+$")) if is_text else F.lit(0)
    n, odd = rows.agg(F.count("*"), bad).first()
    if odd:
        raise ValueError(f"{odd} keys of {column} are not made of digits: their order depends on the database")
    side = f"TRIM({column})" if is_text else column
    quoted = (lambda v: f"'{v}'") if is_text else str
    if not n:
        return ["1 = 0"]
    if n <= reads * max_in:
        found = [quoted(r.key) for r in rows.sort("key").collect()]
        size = -(-n // reads)
        return [f"{side} IN ({', '.join(found[i:i + size])})" for i in range(0, n, size)]
    ranges = (rows.repartitionByRange(reads, "key").groupBy(F.spark_partition_id().alias("part"))
              .agg(F.min("key").alias("low"), F.max("key").alias("high")).sort("low").collect())
    return [f"{side} >= {quoted(r.low)} AND {side} <= {quoted(r.high)}" for r in ranges]


def jdbc_reader(spark: SparkSession, url: str,
                properties: Mapping[str, str]) -> Callable[[str, list[str] | None], DataFrame]:
    """``read(table, predicates)`` over JDBC: a task per predicate, or one task for a
    table without (see ``keyed_catalog``)."""
    def read(table: str, predicates: list[str] | None) -> DataFrame:
        if predicates is None:
            return jdbc_table(spark, url, table.upper(), properties)
        return lower_columns(spark.read.jdbc(url, table.upper(), predicates=predicates, properties=dict(properties)))

    return read


def keyed_catalog(read: Callable[[str, list[str] | None], DataFrame], keys: DataFrame,
                  tables: Iterable[str] = SCHEMA_TABLES, reads: int = 64,
                  max_in: int = 1000) -> dict[str, DataFrame]:
    """The catalog cut to the sheet's ``keys`` (one column) in the database itself, for
    lookups with the same keys: each fact is read by predicates on the codes that the
    tables before it on its path hold. Tables off these paths are read whole.

    Codes are checkpointed, so each is read from the database once. Read ranges may hold
    more rows than the keys; the lookup's joins drop them.
    """
    tables = list(tables)
    missing = [t for t in tables if t in FACT_TABLES and t not in {p[0] for p in KEY_PATHS}]
    if missing:
        raise ValueError(f"no key path to fact tables: {', '.join(missing)}")
    ensure_checkpoint_dir(keys.sparkSession)
    catalog: dict[str, DataFrame] = {}
    plans: dict[tuple | None, list[str]] = {}
    codes: dict[tuple, DataFrame] = {}
    for table, column, source in KEY_PATHS:
        if source is not None and source not in codes:
            codes[source] = catalog[source[0]].select(source[1]).where(F.col(source[1]).isNotNull()).distinct().checkpoint()
        found = codes[source] if source else keys
        if (source, column) not in plans:
            plans[source, column] = key_predicates(found, column, reads, max_in)
        catalog[table] = read(table, plans[source, column])
    return {t: catalog[t] if t in catalog else read(t, None) for t in tables}


def parquet_catalog(spark: SparkSession, root: str,
                    tables: Iterable[str] = SCHEMA_TABLES) -> dict[str, DataFrame]:
    """The lookup schema from ``<root>/<table>`` parquet folders (e.g. a
    nightly export of the database), lower-cased column names."""
    return {t: lower_columns(spark.read.parquet(f"{root}/{t}")) for t in tables}


def export_catalog(catalog: Mapping[str, DataFrame], root: str,
                   bucket_keys: Mapping[str, str] | None = None, buckets: int = 64) -> None:
    """Write a catalog to parquet under ``root``. Tables listed in
    ``bucket_keys`` are also sorted by that key inside each file so later
    scans can skip row groups by key range (min/max statistics)."""
    bucket_keys = bucket_keys or {}
    for name, df in catalog.items():
        key = bucket_keys.get(name)
        out = df.repartitionByRange(buckets, key).sortWithinPartitions(key) if key else df
        out.write.mode("overwrite").parquet(f"{root}/{name}")


def export_co_located(catalog: Mapping[str, DataFrame], root: str, database: str = "default",
                      buckets: int = 64) -> None:
    """Write a catalog as tables ``<database>.<name>`` under ``root``, the facts bucketed
    and sorted by BUCKETS, so that the chains join them without an exchange.

    The contract links get their contract's ``cod_propuesta`` (null without a contract)
    and are bucketed by it; a contract belongs to one proposal. Buckets should be a few
    hundred MB each: 4,096 or more for tables of 1 TB.
    """
    for name, df in catalog.items():
        if name in CONTRACT_LINKS:
            owner = catalog["contratos"].select(F.col("cod_contrato").alias("_contract"), "cod_propuesta").distinct()
            df = df.join(owner, F.col(CONTRACT_LINKS[name]) == F.col("_contract"), "left").drop("_contract")
        out, key = df, BUCKETS.get(name)
        if key:
            out = df.repartition(buckets, key)
        writer = out.write.mode("overwrite").format("parquet").option("path", f"{root}/{name}")
        if key:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(f"{database}.{name}")


def co_located_catalog(spark: SparkSession, database: str = "default",
                       tables: Iterable[str] = SCHEMA_TABLES) -> dict[str, DataFrame]:
    """The tables that ``export_co_located`` wrote; the chains of ``operators.lookup``
    take their buckets into account. The session then lets rows that are dealt by the
    proposal code stay where a join has the contract code as a second key."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return {t: spark.table(f"{database}.{t}") for t in tables}


def read_inferred_csv(spark: SparkSession, path: str, header: bool = True, sep: str = ",") -> DataFrame:
    """CSV with inferred column types (a round-trip check; sheets
    themselves are always read as text)."""
    return spark.read.option("header", header).option("inferSchema", True).option("sep", sep).csv(path)


def key_literal_filter(df: DataFrame, col: str, keys: list[str]) -> DataFrame:
    """Point or small-batch filter ``col IN (...)`` on literal keys: pushed
    down to parquet row groups and into a JDBC WHERE clause."""
    return df.filter(F.col(col).isin(keys))
