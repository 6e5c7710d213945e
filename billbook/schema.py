"""Table schemas of the lake. Names and types are fixed values: readers depend on them."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


MONEY = T.DecimalType(15, 2)

# Ingestion zone: CSV with a header, every column text.
INGESTION = {
    "tb_faturas": _text(
        "id_fatura", "id_cliente", "data_emissao", "data_vencimento",
        "valor_fatura", "valor_pagamento_minimo",
    ),
    "tb_pagamentos": _text(
        "id_pagamento", "id_fatura", "id_cliente", "data_pagamento", "valor_pagamento",
    ),
}

# Text of a line that could not be read as a row.
LINE = "linha"

# Raw zone: Parquet, one directory per run and month. A month that is none is NULL.
RAW = {
    "faturas": T.StructType([
        T.StructField("id_fatura", T.LongType()),
        T.StructField("id_cliente", T.LongType()),
        T.StructField("dt_proc", T.StringType()),
        T.StructField("data_emissao", T.DateType()),
        T.StructField("data_vencimento", T.DateType()),
        T.StructField("valor_fatura", MONEY),
        T.StructField("valor_pagamento_minimo", MONEY),
        T.StructField("ref", T.IntegerType()),
    ]),
    "pagamentos": T.StructType([
        T.StructField("id_pagamento", T.StringType()),
        T.StructField("id_fatura", T.LongType()),
        T.StructField("id_cliente", T.LongType()),
        T.StructField("dt_proc", T.StringType()),
        T.StructField("data_pagamento", T.DateType()),
        T.StructField("valor_pagamento", MONEY),
        T.StructField("ref", T.IntegerType()),
    ]),
}

# Rejects of a raw table: its columns, the reason, and the text of a malformed line, whose columns are NULL.
REJECTS = {
    name: T.StructType([*columns, T.StructField("motivo", T.StringType()), T.StructField(LINE, T.StringType())])
    for name, columns in RAW.items()
}

STAGE = T.StructType([
    T.StructField("id_cliente", T.LongType()),
    T.StructField("dt_proc", T.StringType()),
    T.StructField("fbc_classificacao_dias_pagamento", T.StringType()),
    T.StructField("data_emissao", T.DateType()),
    T.StructField("fvl_valor_fatura", MONEY),
    T.StructField("fvl_valor_pagamento_minimo", MONEY),
    T.StructField("fvl_valor_pagamento", MONEY),
    T.StructField("fbc_classificacao_vlr_pagamento", T.StringType()),
    T.StructField("fvl_pct_fatura_pgto", T.FloatType()),
    T.StructField("fvl_numero_dias_atraso", T.IntegerType()),
    T.StructField("fvl_qtd_transacao", T.IntegerType()),
    T.StructField("ref", T.IntegerType()),
])

CONTROL = T.StructType([
    T.StructField("tb_name", T.StringType()),
    T.StructField("dt_proc", T.StringType()),
    T.StructField("qtd_registros", T.LongType()),
    T.StructField("qtd_rejeitados", T.LongType()),
])

# Which raw table each ingestion table feeds.
RAW_NAME = {"tb_faturas": "faturas", "tb_pagamentos": "pagamentos"}

INVOICE_KEYS = ("id_cliente", "id_fatura")
VERSION_ORDER = ("ref", "dt_proc")
