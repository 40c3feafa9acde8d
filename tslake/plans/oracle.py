"""Oracle SQL (DuckDB dialect) for every registered query with a SQL form.

Tables are the supplied views (orders, lineitem, events, ...). The SQL is
written independently of the Spark code: plain windows (``lag`` over the
wide table), ``row_number`` for latest-wins, grids by ``generate_series``.
Column names and rounding follow ``registry.py``.
"""

from __future__ import annotations

from tslake.sources.catalog import DAILY_SERIES, SERIES_NAMES
from tslake.sources.tables import LINEITEM_TO_CATALOG, ORDERS_TO_CATALOG, PRIORITY_COLUMNS


def _r(expr: str, name: str) -> str:
    return f"round({expr} + 1e-8, 6) AS {name}"  # the nudge: see registry.round6


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _case(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


MEAN = "avg(valor)"

OBS_O = (
    "obs AS (SELECT o_orderpriority AS series_name, CAST(o_orderdate AS DATE) AS data, "
    "o_totalprice AS valor, o_orderkey FROM orders)"
)
OBS_L = (
    "obs AS (SELECT l_returnflag || l_linestatus AS series_name, CAST(l_shipdate AS DATE) AS data, "
    "l_extendedprice AS valor, l_orderkey, l_linenumber FROM lineitem)"
)

RAW_ORDERS = """
raw AS (
  SELECT o_orderpriority AS series_name,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
           THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
         WHEN day(CAST(o_orderdate AS DATE)) = 31 AND o_orderstatus = 'O'
           THEN '31/02/' || CAST(year(CAST(o_orderdate AS DATE)) AS VARCHAR)
         ELSE strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') END AS data_text,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW'
           THEN replace(CAST(o_totalprice AS VARCHAR), '.', ',')
         WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN ''
         ELSE CAST(o_totalprice AS VARCHAR) END AS valor_text,
    o_orderkey
  FROM orders),
parsed AS (
  SELECT *, CAST(try_strptime(data_text, '%d/%m/%Y') AS DATE) AS data,
         TRY_CAST(valor_text AS DOUBLE) AS valor
  FROM raw)"""

EVENTS = """
ev AS (
  SELECT event_id, ts, event_type AS series_name, CAST(ts AS DATE) AS data, value AS valor,
         'b' || strftime(CAST(ts AS DATE), '%Y%m%d') AS batch_id, CAST(ts AS DATE) AS ingestion_date
  FROM events),
per AS (
  SELECT batch_id, ingestion_date, series_name,
         CASE WHEN series_name = 'error' AND max(valor) > 250 THEN 'failed' ELSE 'new_data' END AS series_status
  FROM ev GROUP BY batch_id, ingestion_date, series_name),
batch AS (
  SELECT batch_id, ingestion_date,
         CASE WHEN bool_or(series_status = 'failed') THEN 'failed' ELSE 'committed' END AS status,
         count(*) AS n_series, count(*) FILTER (WHERE series_status = 'failed') AS n_failed
  FROM per GROUP BY batch_id, ingestion_date),
entries AS (
  SELECT per.*, batch.status AS batch_status FROM per JOIN batch USING (batch_id, ingestion_date)),
gated AS (
  SELECT ev.* FROM ev WHERE EXISTS (
    SELECT 1 FROM entries e
    WHERE e.batch_id = ev.batch_id AND e.series_name = ev.series_name
      AND e.batch_status = 'committed' AND e.series_status IN ('new_data', 'success')))"""

PRIORITY_MONTHLY = (
    f"{OBS_O},\nmon AS (SELECT series_name, CAST(date_trunc('month', data) AS DATE) AS reference_month, "
    f"{MEAN} AS valor FROM obs GROUP BY 1, 2)"
)
PRIORITY_PIVOT = (
    PRIORITY_MONTHLY
    + ",\ngp AS (SELECT reference_month, "
    + ", ".join(f"max(CASE WHEN series_name = '{k}' THEN valor END) AS {v}" for k, v in PRIORITY_COLUMNS.items())
    + " FROM mon GROUP BY 1)"
)
PN = list(PRIORITY_COLUMNS.values())

MACRO_GOLD = f"""
src AS (
  SELECT {_case('o_orderpriority', ORDERS_TO_CATALOG)} AS series_name, CAST(o_orderdate AS DATE) AS data,
         o_totalprice AS valor, o_orderkey AS k1, 0 AS k2 FROM orders
  UNION ALL
  SELECT {_case('l_returnflag || l_linestatus', LINEITEM_TO_CATALOG)}, CAST(l_shipdate AS DATE),
         l_extendedprice, l_orderkey, l_linenumber FROM lineitem),
silver AS (
  SELECT series_name, data, valor FROM src
  QUALIFY row_number() OVER (PARTITION BY series_name, data ORDER BY k1 DESC, k2 DESC, valor DESC) = 1),
monthly AS (
  SELECT series_name, CAST(date_trunc('month', data) AS DATE) AS reference_month,
         CASE WHEN series_name IN ({_in(DAILY_SERIES)}) THEN {MEAN}
              ELSE arg_min(valor, data) FILTER (WHERE valor IS NOT NULL) END AS valor
  FROM silver GROUP BY 1, 2),
gold AS (
  SELECT reference_month, {", ".join(f"max(CASE WHEN series_name = '{n}' THEN valor END) AS {n}" for n in SERIES_NAMES)}
  FROM monthly GROUP BY 1)"""


PIPELINE_GOLD = f"""{RAW_ORDERS},
valid AS (
  SELECT {_case('series_name', ORDERS_TO_CATALOG)} AS series_name, data, valor FROM parsed WHERE data IS NOT NULL),
silver AS (SELECT series_name, data, max(valor) AS valor FROM valid GROUP BY 1, 2),
monthly AS (
  SELECT series_name, CAST(date_trunc('month', data) AS DATE) AS reference_month,
         CASE WHEN series_name IN ({_in(DAILY_SERIES)}) THEN {MEAN}
              ELSE arg_min(valor, data) FILTER (WHERE valor IS NOT NULL) END AS valor
  FROM silver GROUP BY 1, 2),
gold AS (
  SELECT reference_month, {", ".join(f"max(CASE WHEN series_name = '{n}' THEN valor END) AS {n}" for n in SERIES_NAMES)}
  FROM monthly GROUP BY 1)"""


def _gold_select(stale: bool = False) -> str:
    cols = []
    for n in SERIES_NAMES:
        if stale and n == "selic":
            cols.append(_r("CASE WHEN reference_month = DATE '1999-12-01' THEN 0.0 ELSE selic END", n))
        else:
            cols.append(_r(n, n))
    return "reference_month, " + ", ".join(cols)


def _mom(x: str, k: int, name: str) -> str:
    return _r(f"({x} / nullif(lag({x}, {k}) OVER w, 0) - 1) * 100", name)


MART_SQL = {
    "mart_monetary": f"""WITH {MACRO_GOLD}
SELECT reference_month, {_r('selic', 'selic')}, {_r('selic_meta', 'selic_meta')},
  {_r('selic - selic_meta', 'selic_spread')},
  {_r('lag(selic) OVER w', 'selic_previous_month')},
  {_r('selic - lag(selic) OVER w', 'selic_change')},
  {_r('lag(selic_meta) OVER w', 'selic_meta_previous_month')},
  {_r('selic_meta - lag(selic_meta) OVER w', 'selic_meta_change')}
FROM gold WINDOW w AS (ORDER BY reference_month)""",
    "mart_activity": f"""WITH {MACRO_GOLD}
SELECT reference_month, {_r('atividade_economica', 'atividade_economica')},
  {_r('atividade_agropecuaria', 'atividade_agropecuaria')}, {_r('atividade_industria', 'atividade_industria')},
  {_r('atividade_servicos', 'atividade_servicos')}, {_r('atividade_impostos', 'atividade_impostos')},
  {_mom('atividade_economica', 1, 'atividade_economica_mom')},
  {_mom('atividade_economica', 12, 'atividade_economica_yoy')},
  {_mom('atividade_industria', 12, 'industria_yoy')},
  {_mom('atividade_servicos', 12, 'servicos_yoy')}
FROM gold WINDOW w AS (ORDER BY reference_month)""",
    "mart_exchange": f"""WITH {MACRO_GOLD}
SELECT reference_month, {_r('dolar_compra', 'dolar_compra')}, {_r('dolar_venda', 'dolar_venda')},
  {_r('(dolar_compra + dolar_venda) / 2', 'dolar_medio')},
  {_r('dolar_venda - dolar_compra', 'spread_cambio')},
  {_r('dolar_venda - lag(dolar_venda) OVER w', 'cambio_change')},
  {_mom('dolar_venda', 1, 'cambio_mom')},
  {_mom('dolar_venda', 12, 'cambio_yoy')}
FROM gold WINDOW w AS (ORDER BY reference_month)""",
    "mart_credit": f"""WITH {MACRO_GOLD}
SELECT reference_month, {_r('credito_concedido_pf', 'credito_concedido_pf')},
  {_r('credito_livre_pf', 'credito_livre_pf')}, {_r('saldo_credito_pessoal', 'saldo_credito_pessoal')},
  {_r('taxa_credito_pf', 'taxa_credito_pf')}, {_r('inadimplencia_pf', 'inadimplencia_pf')},
  {_r('inadimplencia_credito_pessoal_pf', 'inadimplencia_credito_pessoal_pf')},
  {_r('credito_concedido_pf - lag(credito_concedido_pf) OVER w', 'credito_concedido_change')},
  {_mom('credito_concedido_pf', 1, 'credito_concedido_mom')},
  {_mom('credito_concedido_pf', 12, 'credito_concedido_yoy')},
  {_r('inadimplencia_pf - lag(inadimplencia_pf) OVER w', 'inadimplencia_change')}
FROM gold WINDOW w AS (ORDER BY reference_month)""",
    "mart_features": f"""WITH {MACRO_GOLD}
SELECT reference_month, {_r('selic', 'selic')}, {_r('selic_meta', 'selic_meta')},
  {_r('lag(selic, 1) OVER w', 'selic_lag_1')}, {_r('lag(selic, 3) OVER w', 'selic_lag_3')},
  {_r('lag(selic, 6) OVER w', 'selic_lag_6')}, {_r('lag(selic, 12) OVER w', 'selic_lag_12')},
  {_r('ipca', 'ipca')}, {_r('atividade_economica', 'atividade_economica')}, {_r('dolar_venda', 'dolar_venda')},
  {_r('credito_concedido_pf', 'credito_concedido_pf')}, {_r('taxa_credito_pf', 'taxa_credito_pf')},
  {_r('inadimplencia_pf', 'inadimplencia_pf')},
  {_r('lag(inadimplencia_pf, 1) OVER w', 'inadimplencia_lag_1')},
  {_r('lag(inadimplencia_pf, 3) OVER w', 'inadimplencia_lag_3')}
FROM gold WINDOW w AS (ORDER BY reference_month)""",
}



def _macro_gold(valor: str) -> str:
    """MACRO_GOLD with other values in Silver."""
    newest = "row_number() OVER (PARTITION BY series_name, data ORDER BY k1 DESC, k2 DESC, valor DESC) = 1"
    plain = f"SELECT series_name, data, valor FROM src\n  QUALIFY {newest}"
    return MACRO_GOLD.replace(plain, f"SELECT series_name, data, {valor} AS valor FROM ({plain})")


FEED_GOLD = _macro_gold(
    "CASE WHEN data < DATE '1998-01-01' THEN valor * CAST(0.5 AS DOUBLE)"
    " WHEN month(data) IN (3, 9) AND day(data) <= 5 THEN NULL ELSE valor END"
)
CORRECTED_GOLD = _macro_gold("CASE WHEN date_trunc('month', data) = DATE '1996-05-01' THEN valor * 3 ELSE valor END")
GOLD_MACRO_SQL = f"WITH {MACRO_GOLD}\nSELECT {_gold_select()} FROM gold"

MART_SQL["mart_exchange_calendar"] = f"""WITH {MACRO_GOLD}
SELECT g.reference_month, {_r('g.dolar_compra', 'dolar_compra')}, {_r('g.dolar_venda', 'dolar_venda')},
  {_r('(g.dolar_compra + g.dolar_venda) / 2', 'dolar_medio')},
  {_r('g.dolar_venda - g.dolar_compra', 'spread_cambio')},
  {_r('g.dolar_venda - m1.dolar_venda', 'cambio_change')},
  {_r('(g.dolar_venda / nullif(m1.dolar_venda, 0) - 1) * 100', 'cambio_mom')},
  {_r('(g.dolar_venda / nullif(m12.dolar_venda, 0) - 1) * 100', 'cambio_yoy')}
FROM gold g
LEFT JOIN gold m1 ON m1.reference_month = CAST(g.reference_month - INTERVAL 1 MONTH AS DATE)
LEFT JOIN gold m12 ON m12.reference_month = CAST(g.reference_month - INTERVAL 12 MONTH AS DATE)"""

UPSERT_SQL = f"""WITH {OBS_O},
d AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY series_name, data ORDER BY o_orderkey DESC) = 1),
t AS (SELECT series_name, data, valor, o_orderkey FROM d WHERE data < DATE '2000-01-01'),
s AS (SELECT series_name, data, valor * CAST(1.1 AS DOUBLE) AS valor, o_orderkey FROM d WHERE data >= DATE '1999-07-01'),
m AS (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.series_name = t.series_name AND s.data = t.data)
      UNION ALL SELECT * FROM s)
SELECT series_name, data, {_r('valor', 'valor')}, o_orderkey FROM m"""


def _after(op: str) -> str:
    return f"""WITH {OBS_O},
wm AS (SELECT series_name, max(data) AS last FROM obs WHERE data < DATE '2000-01-01' GROUP BY series_name)
SELECT o.series_name, o.data, {_r('o.valor', 'valor')}, o.o_orderkey
FROM obs o LEFT JOIN wm ON o.series_name = wm.series_name
WHERE wm.last IS NULL OR o.data {op}"""


def _windows(freq: str, n: int) -> str:
    return f"""WITH {OBS_O},
spans AS (SELECT series_name, min(data) AS s, max(data) AS e FROM obs GROUP BY series_name)
SELECT series_name, '{freq}' AS frequency, CAST(i AS INTEGER) AS window_index,
  CAST(s + CAST(i * {n} AS INTEGER) AS DATE) AS window_start,
  CAST(least(s + CAST(i * {n} + {n - 1} AS INTEGER), e) AS DATE) AS window_end
FROM spans, LATERAL (SELECT unnest(range(0, CAST(floor(date_diff('day', s, e) / {n}) AS BIGINT) + 1)) AS i)"""


def _priority_features(exprs: list[tuple[str, str]]) -> str:
    cols = ", ".join(_r(e, n) for e, n in exprs)
    return f"WITH {PRIORITY_PIVOT}\nSELECT reference_month, {cols} FROM gp WINDOW w AS (ORDER BY reference_month)"


def _lag_cols():
    out = []
    for n in PN:
        out.append((n, n))
        out += [(f"lag({n}, {k}) OVER w", f"{n}_lag_{k}") for k in (1, 3, 6, 12)]
    return out


SQL: dict[str, str] = {
    "normalize_observations": f"""WITH {RAW_ORDERS}
SELECT series_name, data, {_r('valor', 'valor')}, CAST(year(data) AS INTEGER) AS year,
  CAST(month(data) AS INTEGER) AS month, o_orderkey
FROM parsed WHERE data IS NOT NULL""",
    "quarantine_rows": f"""WITH {RAW_ORDERS}
SELECT series_name, data_text, {_r('valor', 'valor')}, o_orderkey,
  CASE WHEN data_text IS NULL THEN 'missing_date' ELSE 'bad_date' END AS reason
FROM parsed WHERE data IS NULL""",
    "error_report": f"""WITH {RAW_ORDERS}
SELECT series_name, count(*) AS n_rows, count(*) FILTER (WHERE data IS NULL) AS n_quarantined,
  count(*) FILTER (WHERE data IS NOT NULL AND valor IS NULL) AS n_null_valor
FROM parsed GROUP BY series_name""",
    "dedupe_latest": f"""WITH {OBS_O}
SELECT series_name, data, {_r('valor', 'valor')}, o_orderkey FROM obs
QUALIFY row_number() OVER (PARTITION BY series_name, data ORDER BY o_orderkey DESC) = 1""",
    "dedupe_by_sequence": f"""WITH {OBS_O}
SELECT series_name, data, o_orderkey, {_r('valor', 'valor')} FROM obs
QUALIFY row_number() OVER (PARTITION BY series_name, data ORDER BY o_orderkey DESC, valor DESC) = 1""",
    "dedupe_max_by": f"""WITH {OBS_L}
SELECT series_name, data, {_r('valor', 'valor')}, l_orderkey, l_linenumber FROM obs
QUALIFY row_number() OVER (PARTITION BY series_name, data
                           ORDER BY l_orderkey DESC, l_linenumber DESC, valor DESC) = 1""",
    "watermark_per_series": f"""WITH {EVENTS}
SELECT series_name, max(data) AS last_reference_date, count(*) AS rows_ingested,
  max(ingestion_date) AS last_ingestion_date, arg_max(batch_id, ingestion_date) AS last_batch_id
FROM gated GROUP BY series_name""",
    "after_watermark": _after("> wm.last"),
    "after_watermark_inclusive": _after(">= wm.last"),
    "after_watermark_lookback": _after("> wm.last - 7"),
    "classify_series": f"""WITH {OBS_O},
pm AS (SELECT series_name, CAST(date_trunc('month', data) AS DATE) AS batch_month, count(*) AS n_new
       FROM obs GROUP BY 1, 2),
lo AS (SELECT series_name, min(batch_month) AS first_month FROM pm GROUP BY 1),
hi AS (SELECT max(batch_month) AS last_month FROM pm),
grid AS (SELECT lo.series_name, CAST(m AS DATE) AS batch_month
         FROM lo, hi, LATERAL (SELECT unnest(generate_series(CAST(lo.first_month AS TIMESTAMP),
                                    CAST(hi.last_month AS TIMESTAMP), INTERVAL 1 MONTH)) AS m))
SELECT g.series_name, g.batch_month, coalesce(pm.n_new, 0) AS n_new,
  CASE WHEN pm.n_new IS NULL THEN 'no_data' ELSE 'new_data' END AS series_status
FROM grid g LEFT JOIN pm ON g.series_name = pm.series_name AND g.batch_month = pm.batch_month""",
    "fetch_start": f"""WITH {OBS_O},
cat AS (SELECT series_name, min(data) AS available_from FROM obs GROUP BY 1),
wm AS (SELECT series_name, max(data) AS last FROM obs
       WHERE series_name NOT IN ('3-MEDIUM', '5-LOW') AND (data < DATE '2001-01-01' OR series_name = '4-NOT SPECIFIED') GROUP BY 1)
SELECT c.series_name, 'daily' AS frequency, coalesce(wm.last, c.available_from) AS start_date
FROM cat c LEFT JOIN wm ON c.series_name = wm.series_name""",
    "classify_run": f"""WITH {OBS_O},
cat AS (SELECT series_name, min(data) AS available_from FROM obs GROUP BY 1),
wm AS (SELECT series_name, max(data) AS last FROM obs
       WHERE series_name NOT IN ('3-MEDIUM', '5-LOW') AND (data < DATE '2001-01-01' OR series_name = '4-NOT SPECIFIED') GROUP BY 1),
new AS (SELECT o.series_name, count(*) AS n FROM obs o LEFT JOIN wm ON o.series_name = wm.series_name
        WHERE o.data >= DATE '2001-01-01' AND o.series_name NOT IN ('2-HIGH', '3-MEDIUM')
          AND (wm.last IS NULL OR o.data > wm.last) GROUP BY 1)
SELECT c.series_name, coalesce(new.n, 0) AS n_new,
  CASE WHEN coalesce(wm.last, c.available_from) > DATE '2001-01-31' THEN 'up_to_date'
       WHEN coalesce(new.n, 0) > 0 THEN 'new_data'
       WHEN wm.last IS NOT NULL THEN 'no_data' ELSE 'failed' END AS series_status
FROM cat c LEFT JOIN wm ON c.series_name = wm.series_name LEFT JOIN new ON c.series_name = new.series_name""",
    "accept_new_manifests": f"""WITH {EVENTS}
SELECT batch_id, ingestion_date, status FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM batch e WHERE e.batch_id = b.batch_id AND e.status = 'committed'
                  AND e.ingestion_date <= DATE '2024-01-10')""",
    "batch_status_rollup": f"WITH {EVENTS}\nSELECT batch_id, ingestion_date, status, n_series, n_failed FROM batch",
    "committed_gate": f"WITH {EVENTS}\nSELECT event_id, series_name, data, {_r('valor', 'valor')}, batch_id FROM gated",
    "pending_batches": f"""WITH {EVENTS}
SELECT batch_id, ingestion_date FROM batch b
WHERE status = 'committed' AND NOT EXISTS (
  SELECT 1 FROM batch a WHERE a.batch_id = b.batch_id AND a.status = 'committed'
    AND a.ingestion_date <= DATE '2024-01-10')""",
    "pending_batches_log": f"""WITH {EVENTS}
SELECT batch_id, ingestion_date FROM batch
WHERE (status = 'committed' AND ingestion_date > DATE '2024-01-10') OR (status = 'failed' AND ingestion_date <= DATE '2024-01-10')""",
    "carry_forward_batch": f"""WITH {EVENTS}
SELECT batch_id, ingestion_date, series_name,
  last_value(CASE WHEN batch_status = 'committed' AND series_status IN ('new_data', 'success') THEN batch_id END
             IGNORE NULLS) OVER (PARTITION BY series_name ORDER BY ingestion_date, batch_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS source_batch_id
FROM entries""",
    "snapshot_as_of": f"""WITH {EVENTS}
SELECT series_name, data, {_r('valor', 'valor')}, batch_id FROM gated
WHERE ingestion_date <= DATE '2024-01-20'
QUALIFY row_number() OVER (PARTITION BY series_name, data
  ORDER BY ingestion_date DESC, batch_id DESC, ts DESC, event_id DESC, valor DESC) = 1""",
    "manifest_reconcile": f"""WITH {EVENTS},
claimed AS (SELECT ingestion_date, batch_id, series_name FROM entries
            WHERE batch_status = 'committed' AND series_status IN ('new_data', 'success')),
landed AS (SELECT DISTINCT ingestion_date, batch_id, series_name FROM ev
           WHERE NOT (series_name = 'click' AND day(data) % 7 = 0))
SELECT ingestion_date, batch_id, series_name, 'missing_object' AS issue FROM claimed ANTI JOIN landed USING (ingestion_date, batch_id, series_name)
UNION ALL
SELECT ingestion_date, batch_id, series_name, 'orphan_object' AS issue FROM landed l
WHERE NOT EXISTS (SELECT 1 FROM entries c WHERE l.ingestion_date = c.ingestion_date AND l.batch_id = c.batch_id
                  AND l.series_name = c.series_name AND c.batch_status = 'committed')""",
    "batch_id_sanitize": """SELECT event_id,
  'manual__' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS batch_id_raw,
  regexp_replace('manual__' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00', '[:+/]', '_', 'g') AS batch_id
FROM events""",
    "request_windows_daily": _windows("daily", 731),
    "request_windows_monthly": _windows("monthly", 1826),
    "refetch_windows": f"""WITH {OBS_O},
spans AS (SELECT series_name, min(data) AS s, max(data) AS e FROM obs GROUP BY series_name),
win AS (SELECT series_name, e, i, s + CAST(i * 731 AS INTEGER) AS a, least(s + CAST(i * 731 + 730 AS INTEGER), e) + 30 AS b
        FROM spans, LATERAL (SELECT unnest(range(0, CAST(floor(date_diff('day', s, e) / 731) AS BIGINT) + 1)) AS i)),
days AS (SELECT series_name, CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM spans),
open AS (SELECT series_name, d FROM days WHERE NOT EXISTS (
  SELECT 1 FROM win WHERE win.series_name = days.series_name AND i % 3 <> 1 AND win.series_name <> '5-LOW' AND d BETWEEN a AND b)),
isle AS (SELECT series_name, d, d - CAST(row_number() OVER (PARTITION BY series_name ORDER BY d) AS INTEGER) AS g FROM open),
hole AS (SELECT series_name, min(d) AS s, max(d) AS e FROM isle GROUP BY series_name, g)
SELECT series_name, 'daily' AS frequency, CAST(i AS INTEGER) AS window_index, CAST(s + CAST(i * 731 AS INTEGER) AS DATE) AS window_start,
  CAST(least(s + CAST(i * 731 + 730 AS INTEGER), e) AS DATE) AS window_end
FROM hole, LATERAL (SELECT unnest(range(0, CAST(floor(date_diff('day', s, e) / 731) AS BIGINT) + 1)) AS i)""",
    "upsert_merge": UPSERT_SQL,
    "upsert_idempotent": UPSERT_SQL,
    "monthly_avg": f"WITH {PRIORITY_MONTHLY}\nSELECT series_name, reference_month, {_r('valor', 'valor')} FROM mon",
    "monthly_first": f"""WITH {OBS_L},
m AS (SELECT *, CAST(date_trunc('month', data) AS DATE) AS reference_month FROM obs),
g AS (SELECT DISTINCT series_name, reference_month FROM m),
f AS (SELECT series_name, reference_month, valor FROM m WHERE valor IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY series_name, reference_month
                                 ORDER BY data, l_orderkey, l_linenumber, valor) = 1)
SELECT g.series_name, g.reference_month, {_r('f.valor', 'valor')}
FROM g LEFT JOIN f ON g.series_name = f.series_name AND g.reference_month = f.reference_month""",
    "monthly_mixed_frequency": f"""WITH {OBS_O},
m AS (SELECT *, CAST(date_trunc('month', data) AS DATE) AS reference_month FROM obs),
a AS (SELECT series_name, reference_month, {MEAN} AS av FROM m GROUP BY 1, 2),
f AS (SELECT series_name, reference_month, valor FROM m WHERE valor IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY series_name, reference_month ORDER BY data, o_orderkey, valor) = 1)
SELECT a.series_name, a.reference_month,
  {_r("CASE WHEN a.series_name IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN a.av ELSE f.valor END", 'valor')}
FROM a LEFT JOIN f ON a.series_name = f.series_name AND a.reference_month = f.reference_month""",
    "gold_pivot": f"WITH {PRIORITY_PIVOT}\nSELECT reference_month, {', '.join(_r(n, n) for n in PN)} FROM gp",
    "lag_features": _priority_features(_lag_cols()),
    "change": _priority_features([(f"{n} - lag({n}, 1) OVER w", f"{n}_change") for n in PN]),
    "pct_change_mom": _priority_features([(f"({n} / nullif(lag({n}, 1) OVER w, 0) - 1) * 100", f"{n}_mom") for n in PN]),
    "pct_change_yoy": _priority_features([(f"({n} / nullif(lag({n}, 12) OVER w, 0) - 1) * 100", f"{n}_yoy") for n in PN]),
    "spread_midpoint": _priority_features(
        [("urgent", "urgent"), ("low", "low"), ("urgent - low", "urgent_low_spread"), ("(urgent + low) / 2", "urgent_low_midpoint")]
    ),
    "pct_change_calendar": f"""WITH {PRIORITY_MONTHLY},
long AS (SELECT {_case('series_name', PRIORITY_COLUMNS)} AS series_name, reference_month, valor
         FROM mon WHERE reference_month <> DATE '1998-06-01')
SELECT a.series_name, a.reference_month, {_r('a.valor', 'valor')}, {_r('b.valor', 'lag_12')},
  {_r('(a.valor / nullif(b.valor, 0) - 1) * 100', 'yoy_calendar')}
FROM long a LEFT JOIN long b
  ON a.series_name = b.series_name AND b.reference_month = CAST(a.reference_month - INTERVAL 12 MONTH AS DATE)""",
    "gold_macro": GOLD_MACRO_SQL,
    **MART_SQL,
    "publish_append_new": f"""WITH {MACRO_GOLD}
SELECT {_gold_select(stale=True)} FROM gold WHERE reference_month < DATE '2000-01-01'
UNION ALL
SELECT {_gold_select()} FROM gold WHERE reference_month >= DATE '2000-01-01'""",
    "publish_upsert": GOLD_MACRO_SQL,
    "high_water_month": f"WITH {MACRO_GOLD}\nSELECT max(reference_month) AS max_month FROM gold",
    "gold_overwrite": GOLD_MACRO_SQL,
    "mart_materialize": MART_SQL["mart_features"],
    "upsert_out_of_order": f"""WITH {OBS_O}
SELECT series_name, data, {_r('valor', 'valor')}, o_orderkey FROM obs
QUALIFY row_number() OVER (PARTITION BY series_name, data ORDER BY o_orderkey DESC) = 1""",
    "upsert_many_partitions": f"""WITH {OBS_O},
d AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY series_name, data ORDER BY o_orderkey DESC) = 1)
SELECT series_name, data, {_r('CASE WHEN o_orderkey % 2 = 1 THEN valor * 2 ELSE valor END', 'valor')}, o_orderkey,
  CAST(weekofyear(data) AS INTEGER) AS week FROM d""",
    "ingest_run": f"""WITH {RAW_ORDERS},
r AS (SELECT p.series_name, p.data, CAST(o.o_orderdate AS DATE) AS d FROM parsed p JOIN orders o USING (o_orderkey)),
wm AS (SELECT series_name, max(data) AS last FROM r
       WHERE series_name NOT IN ('3-MEDIUM', '5-LOW') AND (d < DATE '2001-01-01' OR series_name = '4-NOT SPECIFIED') GROUP BY 1),
landed AS (SELECT r.series_name, r.data FROM r LEFT JOIN wm USING (series_name)
           WHERE r.d >= DATE '2001-01-01' AND r.series_name NOT IN ('2-HIGH', '3-MEDIUM')
             AND (r.data IS NULL OR wm.last IS NULL OR r.data > wm.last)),
n AS (SELECT series_name, count(*) AS n_landed, count(data) AS n_clean, count(*) - count(data) AS n_quarantined FROM landed GROUP BY 1)
SELECT {_case('c.series_name', ORDERS_TO_CATALOG)} AS series_name, 'failed' AS status,
  CASE WHEN wm.last > DATE '2001-01-31' THEN 'up_to_date' WHEN coalesce(n_clean, 0) > 0 THEN 'new_data'
       WHEN wm.last IS NOT NULL THEN 'no_data' ELSE 'failed' END AS series_status,
  coalesce(n_landed, 0) AS n_landed, coalesce(n_clean, 0) AS n_clean, coalesce(n_quarantined, 0) AS n_quarantined
FROM (SELECT DISTINCT series_name FROM parsed) c LEFT JOIN wm USING (series_name) LEFT JOIN n USING (series_name)""",
    "silver_roundtrip": f"""WITH {OBS_O},
d AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY series_name, data ORDER BY o_orderkey DESC) = 1)
SELECT series_name, data, {_r('valor', 'valor')}, o_orderkey, CAST(year(data) AS INTEGER) AS year
FROM d""",
    "landing_roundtrip": f"WITH {EVENTS}\nSELECT event_id, series_name, data, {_r('valor', 'valor')}, batch_id FROM gated",
    "lake_snapshot": f"""WITH {EVENTS}
SELECT series_name, data, {_r('max(valor)', 'valor')}, max(batch_id) AS batch_id
FROM gated WHERE ingestion_date <= DATE '2024-01-20' GROUP BY series_name, data""",
    "lake_snapshots": f"""WITH {EVENTS},
known AS (SELECT series_name, data, valor, ingestion_date, batch_id FROM gated
          UNION ALL SELECT series_name, DATE '2024-01-01', valor, ingestion_date, batch_id FROM gated),
days AS (SELECT unnest([DATE '2024-01-05', DATE '2024-01-12', DATE '2024-01-20', DATE '2024-02-10']) AS as_of)
SELECT as_of, series_name, data, {_r('valor', 'valor')}, batch_id FROM days JOIN known ON ingestion_date <= as_of
QUALIFY row_number() OVER (PARTITION BY as_of, series_name, data ORDER BY ingestion_date DESC, batch_id DESC, valor DESC) = 1""",
    "content_reconcile": f"""WITH {EVENTS}
SELECT DISTINCT ingestion_date, batch_id, series_name, 'altered_object' AS issue
FROM entries WHERE batch_status = 'committed' AND series_name = 'click' AND day(ingestion_date) % 7 = 0""",
    "rescued_lines": f"""WITH {EVENTS}
SELECT ingestion_date, batch_id, series_name, 'malformed_line' AS reason,
  '{{"event_id":' || event_id || ',"data":"' || strftime(data, '%d/%m/%Y') || '","val' AS raw_line
FROM ev WHERE event_id % 50 = 0""",
    "stream_upsert": f"""WITH {EVENTS}
SELECT series_name, data, {_r('max(valor)', 'valor')}, max(batch_id) AS batch_id
FROM gated GROUP BY series_name, data""",
    "upsert_change_feed": f"""WITH {OBS_O},
d AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY series_name, data ORDER BY o_orderkey DESC) = 1),
s AS (SELECT series_name, data, valor * CAST(1.1 AS DOUBLE) AS valor FROM d WHERE data >= DATE '1999-07-01'),
t AS (SELECT series_name, data, valor FROM d WHERE data < DATE '2000-01-01')
SELECT s.series_name, s.data, CASE WHEN t.data IS NULL THEN 'insert' ELSE 'update' END AS op,
  {_r('t.valor', 'old_valor')}, {_r('s.valor', 'new_valor')}
FROM s LEFT JOIN t ON s.series_name = t.series_name AND s.data = t.data
WHERE t.data IS NULL OR s.valor IS DISTINCT FROM t.valor""",
    "gold_from_feed": f"WITH {FEED_GOLD}\nSELECT {_gold_select()} FROM gold",
    "marts_incremental": MART_SQL["mart_features"].replace(MACRO_GOLD, CORRECTED_GOLD),
    "pipeline_incremental_gold": f"WITH {PIPELINE_GOLD}\nSELECT {_gold_select()} FROM gold",
    "check_not_null": f"""WITH {RAW_ORDERS}
SELECT 'not_null' AS check_name, 'series_name' AS column_name, count(*) FILTER (WHERE series_name IS NULL) AS violations FROM parsed
UNION ALL SELECT 'not_null', 'data', count(*) FILTER (WHERE data IS NULL) FROM parsed
UNION ALL SELECT 'not_null', 'valor', count(*) FILTER (WHERE valor IS NULL) FROM parsed""",
    "check_unique_key": f"""WITH {OBS_O}
SELECT 'unique' AS check_name, 'series_name,data' AS column_name, count(*) AS violations
FROM (SELECT series_name, data FROM obs GROUP BY 1, 2 HAVING count(*) > 1)""",
    "check_accepted_values": f"""SELECT 'accepted_values' AS check_name, 'o_orderstatus' AS column_name,
  count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS violations FROM orders
UNION ALL
SELECT 'accepted_values', 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority NOT IN ({_in(PRIORITY_COLUMNS)})) FROM orders""",
}
