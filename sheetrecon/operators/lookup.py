"""Key lookups through the normalized schema.

Join chains are declared as data: a root table plus a list of ``Link``s
(table, alias, equi-join columns, join type). ``run_chain`` folds them into
DataFrame joins over alias-qualified columns (``alias__column``), so column
pruning and filter pushdown reach every scan.

Chains start from ``propuesta`` (the keyed table) rather than from the link
table the reference starts from: inner joins commute, and starting at the
key lets the sheet's key set cut the fact tables before the big joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fmt import bank_code
from .safety import broadcast_if_small, maybe_member


@dataclass(frozen=True)
class Link:
    alias: str
    table: str
    on: tuple[tuple[str, str], ...]  # ("leftalias.col", "rightcol")
    how: str = "inner"
    links: tuple[Link, ...] = ()  # joined to the table before the table itself is joined


def q(ref: str) -> str:
    """'alias.col' -> qualified column name 'alias__col'."""
    a, c = ref.split(".", 1)
    return f"{a}__{c}"


def qualify(df: DataFrame, alias: str) -> DataFrame:
    """Rename every column to ``alias__column`` (memoized on the DataFrame,
    since the same catalog table is qualified by many chains)."""
    memo = df.__dict__.setdefault("_sheetrecon_qualified", {})
    if alias not in memo:
        memo[alias] = df.toDF(*[f"{alias}__{c}" for c in df.columns])
    return memo[alias]


def run_chain(catalog: Mapping[str, DataFrame], root: tuple[str, str],
              links: Sequence[Link], keys: DataFrame | None = None,
              key_ref: str = "p.legajo") -> DataFrame:
    """Fold ``links`` into joins starting at ``root=(alias, table)``.

    ``keys`` (one string column ``key``) restricts the root before any join
    (the reference's ``WHERE LEGAJO IN (...)``), as a left-semi join whose
    key side is broadcast only when its estimated size is small.
    """
    alias, table = root
    if root == ROOT:
        links = co_located(catalog, links)
    df = qualify(catalog[table], alias)
    if keys is not None:
        df = restrict_to_keys(df, keys, q(key_ref))
    return _fold(catalog, df, links)


def _fold(catalog: Mapping[str, DataFrame], df: DataFrame, links: Sequence[Link]) -> DataFrame:
    for link in links:
        right = _fold(catalog, qualify(catalog[link.table], link.alias), link.links)
        cond = reduce(lambda a, b: a & b,
                      [F.col(q(left)) == F.col(f"{link.alias}__{rc}") for left, rc in link.on])
        df = df.join(right, cond, link.how)
    return df


def flat(links: Sequence[Link]) -> list[Link]:
    """The links one after the other, none joined to another's table first. The same rows
    when links inside a left link are left links too."""
    return [one for link in links for one in (replace(link, links=()), *flat(link.links))]


def co_located(catalog: Mapping[str, DataFrame], links: Sequence[Link]) -> list[Link]:
    """Links for a catalog whose contract links carry the proposal code
    (``sources.tables.export_co_located``): they join on it too, and come while the rows
    are still dealt by it. For other catalogs the links as they are."""
    first, rest = [], []
    for link in links:
        own = link.on[0][0] == "p.cod_propuesta"
        if link.on[0][0] == "ct.cod_contrato" and "cod_propuesta" in catalog[link.table].columns:
            link, own = replace(link, on=(("p.cod_propuesta", "cod_propuesta"), *link.on)), True
        (first if own else rest).append(link)
    return first + rest


def restrict_to_keys(df: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """Rows of ``df`` whose ``col`` (as trimmed text) is in ``keys.key``. A key side too
    large to broadcast first cuts the rows by a bit table of bounded size, so that only
    rows that may match are shuffled."""
    k = keys.select(F.col("key").cast("string").alias("_k")).distinct()
    side, text = broadcast_if_small(k), F.trim(F.col(col).cast("string"))
    if side is k:
        df = maybe_member(df, text, k, F.col("_k"))
    return df.join(side, text == F.col("_k"), "left_semi")


def project(df: DataFrame, cols: Sequence[tuple[str, str | Column]]) -> DataFrame:
    """Select ``(name, 'alias.col' | Column)`` pairs."""
    out = []
    for name, src in cols:
        if callable(src) and not isinstance(src, Column):
            src = src()
        out.append((F.col(q(src)) if isinstance(src, str) else src).alias(name))
    return df.select(*out)


def key_text(ref: str) -> Column:
    """Database key as text, stripped (compared as text, leading zeros kept)."""
    return F.trim(F.col(q(ref)).cast("string"))


# ---------------------------------------------------------------- chains
ROOT = ("p", "propuesta")

# Contract links, clients, contracts, proposals, credits, branches.
CORE = (
    Link("ct", "contratos", (("p.cod_propuesta", "cod_propuesta"),)),
    Link("cr", "creditos", (("p.cod_propuesta", "cod_propuesta"),)),
    Link("s", "sucursales", (("cr.cod_sucursal", "cod_sucursal"),)),
    Link("cc", "contratos_clientes", (("ct.cod_contrato", "cod_contrato"),)),
    Link("c", "clientes", (("cc.cod_cliente", "cod_cliente"),)),
)
# J1 + holder role.
ROLE = CORE + (
    Link("cart", "caracter_titulares", (("cc.cod_caracter_titular", "cod_caracter_titular"),)),
)
# Inner dimensions the reference joins only to filter (no column used).
FILTERS = (
    Link("ed", "estados_deudas", (("cr.cod_estado_deuda", "cod_estado_deuda"),), "left_semi"),
    Link("ec", "estados_contratos", (("ct.cod_estado_contrato", "cod_estado_contrato"),), "left_semi"),
    Link("tp", "tipos_propuestas", (("p.cod_tipo_propuesta", "cod_tipo_propuesta"),), "left_semi"),
    Link("tc", "tipos_contratos", (("ct.cod_tipo_contrato", "cod_tipo_contrato"),), "left_semi"),
    # a contract needs a seller, and the seller a team
    Link("vg", "vendedor", (("ct.cod_vendedor", "cod_vendedor"),)),
    Link("eq", "equipo_vendedores", (("vg.cod_equipo", "cod_equipo"),), "left_semi"),
)
# Every table of the widest query, 12 inner + 16 left, in three parts that meet on
# columns of the result. The plot of a contract: rows of its own until the contract has it.
FULL_PLOT = (
    Link("cp", "contratos_parcelas", (("ct.cod_contrato", "cod_contrato_parcela"),), "left", (
        Link("pa", "parcela", (("cp.cod_parcela", "cod_parcela"),), "left"),
        Link("ep", "estados_parcela", (("pa.cod_estado", "cod_estado_parcela"),), "left"),
        Link("ma", "manzana", (("pa.cod_manzana", "cod_manzana"),), "left"),
        Link("zp", "zonas_parques", (("ma.cod_zona_parque", "cod_zona_parque"),), "left"),
    )),
)
# The sale, from the proposal: contract and credit get what belongs to them while they are
# narrow, then all facts that share the proposal key are joined on it.
FULL_SALE = (
    Link("ct", "contratos", (("p.cod_propuesta", "cod_propuesta"),), links=(
        *FULL_PLOT,
        Link("ec", "estados_contratos", (("ct.cod_estado_contrato", "cod_estado_contrato"),)),
        Link("tc", "tipos_contratos", (("ct.cod_tipo_contrato", "cod_tipo_contrato"),)),
        Link("pvm", "planes_ventas_modelos", (("ct.cod_plan_venta_modelo", "cod_plan_venta_modelo"),), "left"),
        Link("vg", "vendedor", (("ct.cod_vendedor", "cod_vendedor"),)),
        Link("eq", "equipo_vendedores", (("vg.cod_equipo", "cod_equipo"),)),
    )),
    Link("cr", "creditos", (("p.cod_propuesta", "cod_propuesta"),), links=(
        Link("s", "sucursales", (("cr.cod_sucursal", "cod_sucursal"),)),
        Link("ed", "estados_deudas", (("cr.cod_estado_deuda", "cod_estado_deuda"),)),
    )),
    Link("tx", "tarjeta_oxxo", (("p.cod_propuesta", "cod_propuesta"),), "left"),
    Link("cb", "clabe_bancaria", (("p.cod_propuesta", "cod_propuesta"),), "left"),
    Link("tp", "tipos_propuestas", (("p.cod_tipo_propuesta", "cod_tipo_propuesta"),)),
)
# The parties of a contract, from the contract link.
FULL_PARTY = (
    Link("cart", "caracter_titulares", (("cc.cod_caracter_titular", "cod_caracter_titular"),)),
)
# What is known of a client, from the client.
FULL_CLIENT = (
    Link("mco", "medios_cobros", (("c.cod_cliente", "cod_cliente"),), "left"),
    Link("zc", "zona_cobranza", (("mco.cod_zona_cobranza", "cod_zona_cobranza"),), "left"),
    Link("mcd", "medios_cobros_domicilios", (("mco.cod_medio_cobro", "cod_medio_cobro"),), "left"),
    Link("dom", "domicilios", (("mcd.cod_domicilio", "cod_domicilio"),), "left"),
    Link("bar", "barrios", (("dom.cod_barrio", "cod_barrio"),), "left"),
    Link("loc", "localidades", (("dom.cod_localidad", "cod_localidad"),), "left"),
    Link("prv", "provincias", (("loc.cod_provincia", "cod_provincia"),), "left"),
    Link("mcb", "medios_cobros_bancos", (("mco.cod_medio_cobro", "cod_medio_cobro"),), "left"),
)
# J4 + payment methods and their bank holder.
HOLDER = ROLE + (
    Link("mco", "medios_cobros", (("c.cod_cliente", "cod_cliente"),), "left"),
    Link("mcb", "medios_cobros_bancos", (("mco.cod_medio_cobro", "cod_medio_cobro"),), "left"),
)


# ------------------------------------------------------------ lookups
def lookup_core(catalog, keys: DataFrame | None = None) -> DataFrame:
    """J1 rows: key, party, party code, branch, amount, contract date."""
    df = run_chain(catalog, ROOT, CORE, keys)
    return project(df, [("legajo", key_text("p.legajo")), ("nombre_cliente", "c.nombre"),
                        ("cod_cliente", "cc.cod_cliente"), ("sucursal", "s.nombre"),
                        ("monto", "cr.monto"), ("fecha_contrato", "ct.fecha")])


def lookup_role(catalog, keys: DataFrame | None = None, with_filters: bool = False) -> DataFrame:
    """J4 rows: key, party, role, branch, amount, contract date.

    ``with_filters`` adds the inner dimensions of the widest query as
    semi-joins (they only drop contracts lacking a dimension row).
    """
    links = ROLE + (FILTERS if with_filters else ())
    df = run_chain(catalog, ROOT, links, keys)
    return project(df, [("legajo", key_text("p.legajo")), ("nombre_cliente", "c.nombre"),
                        ("caracter_titular", "cart.nombre"), ("sucursal", "s.nombre"),
                        ("monto", "cr.monto"), ("fecha_contrato", "ct.fecha")])


def lookup_contact(catalog, keys: DataFrame | None = None) -> DataFrame:
    """12-column proposal record, DISTINCT.

    The reference joins payment addresses with a correlated ``IN`` inside a
    LEFT JOIN's ON clause, which Spark rejects. Same rows: left-join the
    client to (distinct (client, payment method) pairs joined to payment
    addresses); the distinct is on the pair, before the address join, so
    address repeats survive as they do in the literal form.
    """
    links = CORE + (
        Link("ec", "estados_contratos", (("ct.cod_estado_contrato", "cod_estado_contrato"),)),
        Link("tc", "tipos_contratos", (("ct.cod_tipo_contrato", "cod_tipo_contrato"),)),
        Link("vg", "vendedor", (("ct.cod_vendedor", "cod_vendedor"),)),
    )
    df = run_chain(catalog, ROOT, links, keys)
    pairs = catalog["medios_cobros"].select(
        F.col("cod_cliente").alias("pm__cod_cliente"),
        F.col("cod_medio_cobro").alias("pm__cod_medio_cobro")).distinct()
    addr = pairs.join(qualify(catalog["medios_cobros_domicilios"], "mcd"),
                      F.col("pm__cod_medio_cobro") == F.col("mcd__cod_medio_cobro"))
    df = df.join(addr, F.col("c__cod_cliente") == F.col("pm__cod_cliente"), "left")
    df = df.join(qualify(catalog["domicilios"], "dom"),
                 F.col("mcd__cod_domicilio") == F.col("dom__cod_domicilio"), "left")
    return project(df, [
        ("cod_propuesta", key_text("p.legajo")), ("nombre_cliente", "c.nombre"),
        ("cod_cliente", "cc.cod_cliente"), ("sucursal", "s.nombre"), ("monto", "cr.monto"),
        ("fecha_contrato", "ct.fecha"), ("estado", "ec.estado"), ("tipo_contrato", "tc.nombre"),
        ("telefono", "c.telefono"), ("telefono_movil", "c.telefono_movil"),
        ("direccion", "dom.direccion"), ("asesor", "vg.nombre")]).distinct()


SALE_COLUMNS = [
    ("cod_propuesta", lambda: key_text("p.legajo")), ("sucursal", "s.nombre"), ("monto", "cr.monto"),
    ("fecha_contrato", "ct.fecha"), ("nombre_anterior", "pvm.nombre"), ("estado", "ec.estado"),
    ("tipo_contrato", "tc.nombre"), ("estado_credito", "ed.estado"), ("equipo", "eq.descripcion"),
    ("asesor", "vg.nombre"), ("ubicacion", "pa.legajo"), ("cod_usuario_alta", "tx.cod_usuario_alta"),
    ("cod_barra_oxxo", "tx.codigo_barra"), ("clabe_banco", "cb.clabe"),
]
PARTY_COLUMNS = [
    ("cod_cliente", "cc.cod_cliente"), ("cod_contrato", "cc.cod_contrato"), ("caracter_titular", "cart.nombre"),
]
CLIENT_COLUMNS = [
    ("nombre_cliente", "c.nombre"), ("telefono", "c.telefono"), ("telefono_movil", "c.telefono_movil"),
    ("telefono_laboral", "c.telefono_laboral"), ("dir_cliente", "dom.cod_domicilio"),
    ("medio_cobro", "mco.descripcion"), ("cod_cobrador_asignado", "mco.cod_cobrador_asignado"),
    ("cod_modalidad_cobranza", "zc.cod_modalidad_cobranza"), ("zona_cobranza", "zc.descripcion"),
    ("codigo_cobro_dom", "mcd.cod_domicilio"), ("direccion", "dom.direccion"),
    ("barrio", "bar.nombre"), ("localidad", "loc.nombre"), ("provinca", "prv.nombre"),
    ("manzana", "dom.manzana"), ("tipo_documento", "c.tipo_documento"),
    ("nro_documento", "c.nro_documento"), ("rfc1", "c.cuit"), ("medio_cobro_cuenta", "mcb.nro_cuenta"),
    ("titular_cobro", "mcb.titular"),
]
FULL_COLUMNS = (
    "cod_propuesta", "nombre_cliente", "cod_cliente", "sucursal", "monto", "fecha_contrato",
    "nombre_anterior", "cod_contrato", "estado", "tipo_contrato", "estado_credito", "equipo", "asesor",
    "caracter_titular", "telefono", "telefono_movil", "telefono_laboral", "ubicacion", "dir_cliente",
    "medio_cobro", "cod_cobrador_asignado", "cod_modalidad_cobranza", "zona_cobranza",
    "codigo_cobro_dom", "direccion", "barrio", "localidad", "provinca", "manzana", "cod_usuario_alta",
    "cod_barra_oxxo", "clabe_banco", "tipo_documento", "nro_documento", "rfc1", "medio_cobro_cuenta",
    "titular_cobro",
)


def lookup_full(catalog, keys: DataFrame | None = None) -> DataFrame:
    """The 29-table, 38-column record, DISTINCT.

    Sales, parties and clients meet on the contract and client codes, which are columns
    of the record, and every other column comes from one of the three: a record stands
    for one row of each, so that DISTINCT is taken of the three before they meet. Wide
    records are dealt out once, by client. Co-located tables keep their dealing by
    proposal up to the parties; there sales and parties are made distinct together.
    """
    clients = project(run_chain(catalog, ("c", "clientes"), FULL_CLIENT),
                      [("_cliente", "c.cod_cliente"), *CLIENT_COLUMNS]).distinct()
    if "cod_propuesta" in catalog["contratos_clientes"].columns:
        party = Link("cc", "contratos_clientes", (("ct.cod_contrato", "cod_contrato"),), links=FULL_PARTY)
        links = flat((*FULL_SALE, party))
        rows = project(run_chain(catalog, ROOT, links, keys), SALE_COLUMNS + PARTY_COLUMNS).distinct()
    else:
        sales = project(run_chain(catalog, ROOT, FULL_SALE, keys),
                        [("_contrato", "ct.cod_contrato"), *SALE_COLUMNS]).distinct()
        parties = project(run_chain(catalog, ("cc", "contratos_clientes"), FULL_PARTY), PARTY_COLUMNS).distinct()
        rows = parties.join(sales, F.col("cod_contrato") == F.col("_contrato"))
    return (rows.join(clients, F.col("cod_cliente") == F.col("_cliente"))
            .select(*FULL_COLUMNS, bank_code(F.col("clabe_banco")).alias("clabe_banco_formatted")))


def holder_rows(catalog, keys: DataFrame | None = None) -> DataFrame:
    """J5 DISTINCT rows: key, party, role, bank holder, branch, amount."""
    df = run_chain(catalog, ROOT, HOLDER, keys)
    return project(df, [("legajo", key_text("p.legajo")), ("cliente", "c.nombre"),
                        ("caracter_titular", "cart.nombre"), ("titular_cobro", "mcb.titular"),
                        ("sucursal", "s.nombre"), ("monto", "cr.monto")]).distinct()


def lookup_by_key(lookup: DataFrame, key: str, order: Sequence[str], key_col: str = "legajo") -> DataFrame:
    """Point lookup (P11): the first row of one key in a total order, or none."""
    w = Window.partitionBy(key_col).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (lookup.filter(F.col(key_col) == F.lit(key))
            .withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn"))


#: Codes that a point lookup pushes to the fact scans as literals.
POINT_CODES = 10_000


def point_catalog(catalog: Mapping[str, DataFrame], keys: Sequence[str]) -> Mapping[str, DataFrame]:
    """The catalog cut to a few literal keys, for point lookups.

    The keys are resolved to proposal and contract codes once; these go to every
    fact scan as ``IN`` literals, which the reader can use to skip data. Keys that
    resolve to more than POINT_CODES codes are left to the joins.
    """
    def codes(rows: DataFrame, column: str) -> list | None:
        got = [r[0] for r in rows.select(column).distinct().limit(POINT_CODES + 1).collect()]
        return got if len(got) <= POINT_CODES else None

    wanted = catalog["propuesta"].where(F.trim(F.col("legajo").cast("string")).isin(list(keys)))
    out = dict(catalog) | {"propuesta": wanted}
    proposals = codes(wanted, "cod_propuesta")
    if proposals is None:
        return out
    for name in ("propuesta", "contratos", "creditos"):
        out[name] = out[name].where(F.col("cod_propuesta").isin(proposals))
    contracts = codes(out["contratos"], "cod_contrato")
    if contracts is not None:
        for name in ("contratos", "contratos_clientes"):
            out[name] = out[name].where(F.col("cod_contrato").isin(contracts))
    return out


def lookup_by_key_or_first(lookup: DataFrame, key: str, order: Sequence[str],
                           key_col: str = "legajo") -> DataFrame:
    """O3: the point lookup of ``key``; when the key is absent, the first
    existing key (lowest in key order) stands in. One top-1 over the lookup:
    rows of the key before all others."""
    first = [F.when(F.col(key_col) == F.lit(key), 0).otherwise(1), F.col(key_col)]
    return lookup.orderBy(*first, *[F.col(c).asc_nulls_first() for c in order]).limit(1)


# ------------------------------------------------------------ combination
def _best_tier(tiers: Sequence[DataFrame], key_col: str, last_wins: bool) -> DataFrame:
    """Union of the tiers (numbered from 1) with, per key, the rows of its first
    or last tier: each tier is evaluated once, and one shuffle on the key
    follows (with a group limit before it)."""
    tagged = [t.withColumn("_tier", F.lit(i)) for i, t in enumerate(tiers, start=1)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    place = F.col("_tier").desc() if last_wins else F.col("_tier").asc()
    w = Window.partitionBy(key_col).orderBy(place)
    return rows.withColumn("_rk", F.rank().over(w)).filter("_rk = 1").drop("_rk")


def merge_lookups(tiers: Sequence[DataFrame], key_col: str = "legajo") -> DataFrame:
    """Union of lookups where a later tier's row replaces an earlier
    tier's row for the same key (dict.update semantics)."""
    return _best_tier(tiers, key_col, last_wins=True).drop("_tier")


def fallback_lookup(tiers: Sequence[DataFrame], key_col: str = "legajo") -> DataFrame:
    """Tier 1 rows, then for keys still missing tier 2 rows, and so on;
    ``_tier`` says which answered (missing columns become null)."""
    return _best_tier(tiers, key_col, last_wins=False)
