"""Series catalogue (O-03): the 32 published macro series as a broadcast dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: must equal the published catalogue for results to match.
# (series_name, source code, frequency, available_from, unit, description),
# in catalogue order. The unit is kept as published; ``catalog_frame``
# normalises the singular spelling BRL_MILLION to BRL_MILLIONS.
# ---------------------------------------------------------------------------
SERIES = [
    ("selic", 1178, "daily", "1986-06-04", "PERCENT_ANNUAL", "Taxa Selic anualizada."),
    ("selic_meta", 432, "daily", "1999-03-05", "PERCENT_ANNUAL", "Meta da taxa Selic definida pelo Copom."),
    ("ipca", 433, "monthly", "1980-01-01", "PERCENT", "Indice Nacional de Precos ao Consumidor Amplo."),
    ("atividade_economica", 24363, "monthly", "2003-01-01", "INDEX", "Indice de Atividade Economica do Banco Central."),
    ("atividade_agropecuaria", 29601, "monthly", "2003-01-01", "INDEX", "IBC-Br - Agropecuaria."),
    ("atividade_industria", 29602, "monthly", "2003-01-01", "INDEX", "IBC-Br - Industria."),
    ("atividade_servicos", 29605, "monthly", "2003-01-01", "INDEX", "IBC-Br - Servicos."),
    ("atividade_impostos", 29608, "monthly", "2003-01-01", "INDEX", "IBC-Br - Impostos."),
    ("dolar_venda", 1, "daily", "1984-11-28", "BRL_PER_USD", "Taxa de cambio do dolar americano - Venda."),
    ("dolar_compra", 10813, "daily", "1984-11-28", "BRL_PER_USD", "Taxa de cambio do dolar americano - Compra."),
    ("credito_concedido_pf", 20633, "monthly", "2011-03-01", "BRL_MILLIONS", "Concessoes de credito para pessoas fisicas."),
    ("credito_livre_pf", 20662, "monthly", "2011-03-01", "BRL_MILLIONS", "Concessoes de credito livre para pessoas fisicas."),
    ("saldo_credito_pessoal", 20580, "monthly", "2007-03-01", "BRL_MILLIONS", "Saldo de credito pessoal."),
    ("taxa_credito_pf", 27628, "monthly", "2011-03-01", "PERCENT_ANNUAL", "Taxa media de juros do credito nao rotativo para pessoas fisicas."),
    ("inadimplencia_pf", 21084, "monthly", "2011-03-01", "PERCENT", "Inadimplencia da carteira de credito de pessoas fisicas."),
    ("inadimplencia_credito_pessoal_pf", 21120, "monthly", "2011-03-01", "PERCENT", "Inadimplencia do credito pessoal para pessoas fisicas."),
    ("saldo_credito_pj", 22047, "monthly", "2012-01-01", "BRL_MILLIONS", "Saldo das operacoes de credito para pessoas juridicas."),
    ("taxa_credito_pj", 20715, "monthly", "2011-03-01", "PERCENT_ANNUAL", "Taxa media de juros das operacoes de credito para pessoas juridicas."),
    ("taxa_credito_nao_rotativo_pj", 27624, "monthly", "2011-03-01", "PERCENT_ANNUAL", "Taxa media de juros do credito nao rotativo para pessoas juridicas."),
    ("inadimplencia_pj", 21083, "monthly", "2011-03-01", "PERCENT", "Inadimplencia da carteira de credito de pessoas juridicas."),
    ("comprometimento_renda", 29266, "monthly", "2005-03-01", "PERCENT", "Comprometimento de renda das familias."),
    ("endividamento_familias", 29037, "monthly", "2005-01-01", "PERCENT", "Endividamento das familias."),
    ("credito_governo_federal", 22025, "monthly", "2012-01-01", "BRL_MILLIONS", "Saldo das operacoes de credito do Governo Federal."),
    ("credito_governos_estaduais_municipais", 22026, "monthly", "2012-01-01", "BRL_MILLIONS", "Saldo das operacoes de credito dos governos estaduais e municipais."),
    ("credito_agropecuaria", 22027, "monthly", "2012-01-01", "BRL_MILLION", "Saldo das operacoes de credito ao setor agropecuario."),
    ("credito_industria", 22043, "monthly", "2012-01-01", "BRL_MILLION", "Saldo das operacoes de credito ao setor industrial."),
    ("credito_administracao_publica", 22039, "monthly", "2012-01-01", "BRL_MILLION", "Saldo das operacoes de credito ao setor de governo."),
    ("credito_servicos_financeiros", 27742, "monthly", "2012-01-01", "BRL_MILLION", "Saldo das operacoes de credito ao setor de servicos financeiros e seguros."),
    ("divida_mobiliaria_tesouro", 4154, "monthly", "2000-01-31", "BRL_MILLIONS", "Divida mobiliaria federal em titulos do Tesouro Nacional."),
    ("divida_indexada_selic", 4177, "monthly", "2000-01-31", "PERCENT", "Participacao da divida mobiliaria indexada a Selic."),
    ("divida_indexada_cambio", 4173, "monthly", "2000-01-31", "PERCENT", "Participacao da divida mobiliaria indexada ao cambio."),
    ("divida_indexada_outros", 4180, "monthly", "2000-01-31", "PERCENT", "Participacao da divida mobiliaria indexada a outros indexadores."),
]
# Request-window lengths in days, inclusive of both ends, per frequency.
WINDOW_DAYS = {"monthly": 1826, "daily": 731}
# ---------------------------------------------------------------------------

FREQUENCIES = ("daily", "monthly")
SERIES_NAMES = [row[0] for row in SERIES]
DAILY_SERIES = [row[0] for row in SERIES if row[2] == "daily"]

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("series_name", T.StringType(), False),
        T.StructField("code", T.IntegerType(), False),
        T.StructField("frequency", T.StringType(), False),
        T.StructField("available_from", T.DateType(), False),
        T.StructField("unit", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
    ]
)


def normalise_unit(unit: Column) -> Column:
    return F.regexp_replace(unit, r"^BRL_MILLION$", "BRL_MILLIONS")


def catalog_frame(spark: SparkSession, rows=None) -> DataFrame:
    """The catalogue as a DataFrame. Its size is fixed by ``SERIES`` (or the
    caller's rows), so it is always safe to broadcast."""
    rows = SERIES if rows is None else rows
    data = [(n, int(c), f, date.fromisoformat(a) if isinstance(a, str) else a, u, d) for n, c, f, a, u, d in rows]
    df = spark.createDataFrame(data, CATALOG_SCHEMA)
    return df.withColumn("unit", normalise_unit(F.col("unit")))


def frequency_frame(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    """A small ``(series_name, frequency)`` dimension for ad-hoc series."""
    return spark.createDataFrame(sorted(mapping.items()), "series_name string, frequency string")
