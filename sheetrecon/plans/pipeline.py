"""The fill pipeline (F5): sheet -> keys -> lookup -> pick -> fill.

Plan shape: the sheet's strict keys (distinct) cut ``propuesta`` with a
left-semi join before the contract and party joins; the lookup is reduced
to one party per key by the priority pick (partial top-1 before the key
shuffle); the sheet is left-joined to that one-row-per-key result. Nothing
is collected; the caller picks the sink.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators.fill import fill_gated, sheet_keys
from ..operators.lookup import lookup_role
from ..operators.pick import priority_pick
from ..sources.sheet import require_width


@dataclass(frozen=True)
class FillRequest:
    key_cell: str = "c1"            # column B
    gate: str = "c5"                # column F, the client cell
    targets: Mapping[str, str] = field(default_factory=lambda: {
        "c5": "nombre_cliente", "c7": "fecha_contrato", "c21": "monto"})
    start_row: int = 11
    key_predicate: str = "strict"
    dimension_filters: bool = True  # keep the widest query's inner dimensions


def pick_parties(catalog: Mapping[str, DataFrame], keys: DataFrame,
                 dimension_filters: bool = True) -> DataFrame:
    """One party per key for the given key set (W1 over J4 + filters)."""
    return priority_pick(lookup_role(catalog, keys, with_filters=dimension_filters))


def fill_sheet(sheet: DataFrame, catalog: Mapping[str, DataFrame],
               req: FillRequest = FillRequest()) -> DataFrame:
    """Filled sheet with ``filled`` / ``is_holder`` flags per row. A sheet without a
    requested cell is an error."""
    targets = dict(req.targets)
    for cell in (req.key_cell, req.gate, *targets):
        require_width(sheet, int(cell[1:]) + 1)
    keys = sheet_keys(sheet, req.key_cell, req.start_row, req.key_predicate)
    picked = pick_parties(catalog, keys, req.dimension_filters)
    return fill_gated(sheet, picked, targets, gate=req.gate, key_cell=req.key_cell,
                      start_row=req.start_row)


@dataclass(frozen=True)
class ProcessRequest:
    """The reference's processing request: target column as a letter ('F'),
    a cell name ('c5') or a banner label ('CLIENTE'); data start row; key
    column as a letter or cell name."""
    target_column: str = "CLIENTE"
    data_start_row: int = 11
    propuesta_column: str = "B"


def resolve_column(sheet: DataFrame, spec: str, header_rows: int = 10) -> tuple[DataFrame, str]:
    """Letter -> cell name; cell name as is; otherwise a banner label found
    in the first ``header_rows`` rows, or a newly appended column (P2, P3)."""
    import re

    from ..functions.columns import index_of
    from ..sources.sheet import target_column
    if re.fullmatch(r"c\d+", spec):
        return sheet, spec
    if re.fullmatch(r"[A-Za-z]{1,2}", spec):
        return sheet, f"c{index_of(spec)}"
    return target_column(sheet, spec, header_rows)


def process_sheet(sheet: DataFrame, catalog: Mapping[str, DataFrame],
                  req: ProcessRequest = ProcessRequest(), stage: str | None = None):
    """The request path (F4 with J2): loose keys of the key column, the
    12-field proposal record per key (last row per key in a total order),
    every matched row's target cell set to the client name.

    Returns (filled sheet, a result row per file, unmatched messages). All three follow
    from the filled rows, so each evaluates the lookup once; with ``stage`` (a shared
    folder) the rows are written there and every table is read once for all three.
    """
    from pyspark.sql import functions as F

    from ..operators.fill import UNMATCHED_MESSAGE, fill_always, sheet_keys
    from ..operators.lookup import lookup_contact
    from ..operators.pick import last_per_key
    from ..operators.runlog import summary_of
    from ..sources.sheet import FILE, ROW_NO

    sheet, target = resolve_column(sheet, req.target_column)
    _, key_cell = resolve_column(sheet, req.propuesta_column)
    keys = sheet_keys(sheet, key_cell, req.data_start_row, "loose")
    rows = lookup_contact(catalog, keys)
    record = last_per_key(rows, "cod_propuesta", [c for c in rows.columns if c != "cod_propuesta"])
    filled = fill_always(sheet, record, target=target, key_cell=key_cell,
                         key_col="cod_propuesta", start_row=req.data_start_row, with_key=True)
    if stage is not None:
        filled.write.mode("overwrite").parquet(stage)
        filled = sheet.sparkSession.read.schema(filled.schema).parquet(stage)
    rows = filled.where("key is not null").select(FILE, ROW_NO, "key", "matched")
    unmatched = rows.where("not matched").select("key", FILE, ROW_NO, F.concat(
        F.lit(UNMATCHED_MESSAGE), F.col("key")).alias("message"))
    return filled.drop("key"), summary_of(rows), unmatched
