"""The five analytic marts as data (O-26, O-26b, O-27a..e).

Each mart is a list of ``Feature`` specs applied to Gold in long form by
``wide_features``; a new mart is a new list, not new code.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from tslake.operators.features import Feature, affected_rows, dependencies, select_features, wide_cells, wide_features
from tslake.operators.small import small_side
from tslake.operators.upsert import merge_frames


def _values(*names: str) -> list[Feature]:
    return [Feature(n, "value", (n,)) for n in names]


# FIXED VALUES: output columns of each mart, in published order.
MARTS: dict[str, list[Feature]] = {
    "fct_monetary_policy": [
        *_values("selic", "selic_meta"),
        Feature("selic_spread", "spread", ("selic", "selic_meta")),
        Feature("selic_previous_month", "lag", ("selic",), 1),
        Feature("selic_change", "change", ("selic",), 1),
        Feature("selic_meta_previous_month", "lag", ("selic_meta",), 1),
        Feature("selic_meta_change", "change", ("selic_meta",), 1),
    ],
    "fct_economic_activity": [
        *_values(
            "atividade_economica",
            "atividade_agropecuaria",
            "atividade_industria",
            "atividade_servicos",
            "atividade_impostos",
        ),
        Feature("atividade_economica_mom", "pct_change", ("atividade_economica",), 1),
        Feature("atividade_economica_yoy", "pct_change", ("atividade_economica",), 12),
        Feature("industria_yoy", "pct_change", ("atividade_industria",), 12),
        Feature("servicos_yoy", "pct_change", ("atividade_servicos",), 12),
    ],
    "fct_exchange_rate": [
        *_values("dolar_compra", "dolar_venda"),
        Feature("dolar_medio", "midpoint", ("dolar_compra", "dolar_venda")),
        Feature("spread_cambio", "spread", ("dolar_venda", "dolar_compra")),
        Feature("cambio_change", "change", ("dolar_venda",), 1),
        Feature("cambio_mom", "pct_change", ("dolar_venda",), 1),
        Feature("cambio_yoy", "pct_change", ("dolar_venda",), 12),
    ],
    "fct_credit_pf": [
        *_values(
            "credito_concedido_pf",
            "credito_livre_pf",
            "saldo_credito_pessoal",
            "taxa_credito_pf",
            "inadimplencia_pf",
            "inadimplencia_credito_pessoal_pf",
        ),
        Feature("credito_concedido_change", "change", ("credito_concedido_pf",), 1),
        Feature("credito_concedido_mom", "pct_change", ("credito_concedido_pf",), 1),
        Feature("credito_concedido_yoy", "pct_change", ("credito_concedido_pf",), 12),
        Feature("inadimplencia_change", "change", ("inadimplencia_pf",), 1),
    ],
    "mart_macro_credit_features": [
        *_values("selic", "selic_meta"),
        Feature("selic_lag_1", "lag", ("selic",), 1),
        Feature("selic_lag_3", "lag", ("selic",), 3),
        Feature("selic_lag_6", "lag", ("selic",), 6),
        Feature("selic_lag_12", "lag", ("selic",), 12),
        *_values(
            "ipca",
            "atividade_economica",
            "dolar_venda",
            "credito_concedido_pf",
            "taxa_credito_pf",
            "inadimplencia_pf",
        ),
        Feature("inadimplencia_lag_1", "lag", ("inadimplencia_pf",), 1),
        Feature("inadimplencia_lag_3", "lag", ("inadimplencia_pf",), 3),
    ],
}


def build_mart(gold_long: DataFrame, name: str, axis: DataFrame | None = None, calendar: bool = False) -> DataFrame:
    """Build a mart; ``calendar=True`` makes every lag calendar-exact (O-24b)
    instead of positional over the months of Gold."""
    feats = MARTS[name]
    if calendar:
        feats = [replace(f, calendar=True) if f.op in ("lag", "change", "pct_change") else f for f in feats]
    return wide_features(gold_long, feats, axis)


def update_mart(
    mart: DataFrame, gold_long: DataFrame, name: str, cells: DataFrame, axis: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(the mart brought up to date, its rows that were computed anew). ``cells``
    (series_name, reference_month) are those of Gold that changed since ``mart``
    was built; only the months that read one of them are computed, a dozen rows
    for a corrected month, and put in place of the former rows."""
    feats = MARTS[name]
    added = axis.join(mart.select("reference_month"), "reference_month", "left_anti").select("reference_month")
    rows = small_side(affected_rows(cells, added, feats, axis))
    anew = small_side(wide_features(gold_long, feats, axis, rows))
    return merge_frames(mart, anew, ["reference_month"]), anew


def build_marts(gold_long: DataFrame, axis: DataFrame | None = None) -> dict[str, DataFrame]:
    """All marts from one aggregation: the cells that any of them reads, one row
    per month, are computed once, and each mart is a projection of them."""
    needs = sorted({need for feats in MARTS.values() for need in dependencies(feats)})
    cells = small_side(wide_cells(gold_long, needs, axis))
    return {name: select_features(cells, feats) for name, feats in MARTS.items()}
