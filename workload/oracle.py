"""The queries of `workload.queries` as SQL for DuckDB.

Written without the library: windows are `interval` arithmetic, deduplication is
a join with the maximum, book columns are one filtered aggregate each, and their
numbers come from counting columns per block.
"""

from __future__ import annotations

import re

LOAD_1, LOAD_2, LOAD_3 = "20000201080000", "20000202080000", "20000203080000"
RUN = "20000204220000"
REF = "date '2000-02-01'"
FIRST, LAST = 199902, 200002

ORDERS = """
ord as (
  select o_orderkey as id_fatura,
         case when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'P' then null
              else o_custkey end as id_cliente,
         o_orderstatus, o_orderpriority,
         cast(o_orderdate as date) as data_emissao,
         cast(o_orderdate as date) + 10 as data_vencimento,
         cast(o_totalprice as decimal(15,2)) as valor_fatura,
         cast(o_totalprice as decimal(15,2)) * cast(0.15 as decimal(3,2)) as exact_minimum
  from orders
)"""

RAW = ORDERS + f""",
inv as (
  select id_fatura, id_cliente, dt_proc, data_emissao, data_vencimento,
         cast(valor_fatura + extra as decimal(15,2)) as valor_fatura,
         cast(exact_minimum as decimal(15,2)) as valor_pagamento_minimo,
         cast(strftime(data_emissao, '%Y%m') as int) as ref
  from (
    select *, '{LOAD_1}' as dt_proc, cast(0 as decimal(4,2)) as extra from ord
    union all
    select *, '{LOAD_2}', cast(10 as decimal(4,2)) from ord where o_orderstatus = 'F'
  )
),
pay as (
  select cast(id_fatura as varchar) || cast(l_linenumber as varchar) as id_pagamento,
         id_fatura, id_cliente,
         case l_returnflag when 'N' then '{LOAD_1}' when 'A' then '{LOAD_2}' else '{LOAD_3}' end as dt_proc,
         data_pagamento, valor_pagamento,
         cast(strftime(data_pagamento, '%Y%m') as int) as ref
  from (
    select *,
           data_vencimento + cast((id_fatura + 3 * l_linenumber) % 21 - 10 as int) as data_pagamento,
           case (id_fatura + l_linenumber) % 5
             when 0 then minimum
             when 1 then valor_fatura
             when 2 then cast(minimum * cast(0.50 as decimal(3,2)) as decimal(15,2))
             when 3 then cast(valor_fatura * cast(0.50 as decimal(3,2)) as decimal(15,2))
             else cast(valor_fatura * cast(1.10 as decimal(3,2)) as decimal(15,2))
           end as valor_pagamento
    from (
      select ord.*, l_linenumber, l_returnflag, cast(exact_minimum as decimal(15,2)) as minimum
      from lineitem join ord on l_orderkey = id_fatura
    )
  )
)"""

TEXT = ORDERS + """,
txt as (
  select case when o_orderpriority = '4-NOT SPECIFIED' then 'F' else 'F-' end
           || cast(id_fatura as varchar) as id_fatura,
         cast(id_cliente as varchar) as id_cliente,
         strftime(data_emissao, '%Y-%m-%d') as data_emissao,
         case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then 'sem data'
              else strftime(data_vencimento, '%Y-%m-%d') end as data_vencimento,
         cast(valor_fatura as varchar) as valor_fatura,
         cast(cast(exact_minimum as decimal(19,4)) as varchar) as valor_pagamento_minimo
  from ord
)"""

# Lines of the extract; kinds 0 to 3 are malformed.
LINES = TEXT + """,
lin as (
  select *, f1 || ',' || f2 || ',' || case kind
      when 0 then f3 || ',' || f4 || ',' || replace(f5, '.', ',') || ',' || replace(f6, '.', ',')
      when 1 then f3
      when 2 then '"' || f3 || ',' || f4 || ',' || f5 || ',' || f6
      when 3 then f3 || ',' || f4 || ',' || f5 || ',"' || f6
    end as linha
  from (
    select *, id_fatura as f1, coalesce(id_cliente, '') as f2, data_emissao as f3, data_vencimento as f4,
           valor_fatura as f5, valor_pagamento_minimo as f6,
           cast(regexp_extract(id_fatura, '[0-9]+') as bigint) % 11 as kind
    from txt
  )
)"""

INV_SHOWN = """id_fatura, id_cliente, dt_proc,
  strftime(data_emissao, '%Y-%m-%d') as data_emissao,
  strftime(data_vencimento, '%Y-%m-%d') as data_vencimento,
  cast(valor_fatura as double) as valor_fatura,
  cast(valor_pagamento_minimo as double) as valor_pagamento_minimo,
  cast(ref as bigint) as ref"""
PAY_SHOWN = """id_pagamento, id_fatura, id_cliente, dt_proc,
  strftime(data_pagamento, '%Y-%m-%d') as data_pagamento,
  cast(valor_pagamento as double) as valor_pagamento,
  cast(ref as bigint) as ref"""


def _latest(name: str, source: str, where: str = "true", keys: str = "id_cliente, id_fatura") -> str:
    """Rows of the greatest (ref, dt_proc) per key, ties kept."""
    return f"""
{name} as (
  select t.*
  from {source} t
  join (
    select {keys}, max(cast(ref as varchar) || dt_proc) as top
    from {source} where {where} group by {keys}
  ) m using ({keys})
  where {where} and cast(ref as varchar) || dt_proc = top
)"""


def _literal_dedup(name: str, source: str, where: str = "true") -> str:
    """The dedup join without its version test: all versions, NULL keys as all-NULL rows."""
    return f"""
{name} as (
  select b.*
  from (select distinct id_cliente, id_fatura from {source} where {where}) a
  left join (select * from {source} where {where}) b
    on a.id_cliente = b.id_cliente and a.id_fatura = b.id_fatura
)"""


def _by_payment(name: str, source: str, where: str) -> str:
    return _latest(name, source, where, "id_cliente, id_fatura" + ", id_pagamento" * (source == "pay"))


def _joined(where: str = "true", dedup=_latest, raw: str = RAW) -> str:
    return raw + "," + dedup("inv1", "inv", where) + "," + dedup("pay1", "pay", where) + """,
joined as (
  select a.id_fatura, a.id_cliente, a.data_emissao, a.data_vencimento, a.valor_fatura,
         a.valor_pagamento_minimo, b.data_pagamento, b.valor_pagamento
  from inv1 a left join pay1 b on a.id_fatura = b.id_fatura and a.id_cliente = b.id_cliente
)"""


def _variables(where: str = "true", dedup=_latest, literal_pct: bool = False, raw: str = RAW) -> str:
    ratio = "100 * cast(valor_pagamento as double) / nullif(cast(valor_fatura as double), 0)"
    pct = ratio if literal_pct else (
        f"case vlr when 'SEM_PAGAMENTO' then 0 when 'PAGAMENTO_TOTAL' then 100 else {ratio} end"
    )
    return _joined(where, dedup, raw) + f""",
classed as (
  select *,
    case when data_pagamento is null then 'SEM_PAGAMENTO'
         when data_pagamento > data_vencimento then 'PAGAMENTO_ATRASADO'
         when data_pagamento = data_vencimento then 'PAGAMENTO_NO_PRAZO'
         when data_pagamento < data_vencimento then 'PAGAMENTO_ANTECIPADO' end as dias,
    case when valor_pagamento is null then 'SEM_PAGAMENTO'
         when valor_pagamento = valor_pagamento_minimo then 'PAGAMENTO_MINIMO'
         when valor_pagamento < valor_pagamento_minimo then 'PAGAMENTO_INSUFICIENTE'
         when valor_pagamento = valor_fatura then 'PAGAMENTO_TOTAL'
         when valor_pagamento < valor_fatura then 'PAGAMENTO_PARCIAL' end as vlr
  from joined
),
vars0 as (
  select *,
    case dias when 'SEM_PAGAMENTO' then {REF} - data_vencimento
              when 'PAGAMENTO_ATRASADO' then data_pagamento - data_vencimento
              when 'PAGAMENTO_NO_PRAZO' then 0
              when 'PAGAMENTO_ANTECIPADO' then -1 end as atraso,
    cast(cast({pct} as float) as double) as pct
  from classed
),
-- Percentages in whole numbers of 24 bits: their sums do not depend on the order.
vars as (
  select *, floor(pct / 16777216) as p0, floor(pct) - 16777216 * floor(pct / 16777216) as p1,
         floor(pct * 16777216) - 16777216 * floor(pct) as p2,
         floor(r * 16777216) as p3, floor((r * 16777216 - floor(r * 16777216)) * 16777216) as p4
  from (select *, (pct - floor(pct)) * 16777216 - floor((pct - floor(pct)) * 16777216) as r from vars0)
)"""


IN_RANGE = f"ref between {FIRST} and {LAST}"

STAGE_SHOWN = f"""select id_cliente, cast(200002 as bigint) as ref, '{RUN}' as dt_proc,
  dias as fbc_classificacao_dias_pagamento,
  strftime(data_emissao, '%Y-%m-%d') as data_emissao,
  cast(valor_fatura as double) as fvl_valor_fatura,
  cast(valor_pagamento_minimo as double) as fvl_valor_pagamento_minimo,
  cast(valor_pagamento as double) as fvl_valor_pagamento,
  vlr as fbc_classificacao_vlr_pagamento,
  round(pct, 4) as fvl_pct_fatura_pgto,
  cast(atraso as bigint) as fvl_numero_dias_atraso,
  cast(1 as bigint) as fvl_qtd_transacao
from vars"""

DIAS, VLR = "fbc_classificacao_dias_pagamento", "fbc_classificacao_vlr_pagamento"
CLASSES = [
    ("dias", DIAS, "SEM_PAGAMENTO"),
    ("dias", DIAS, "PAGAMENTO_ATRASADO"),
    ("dias", DIAS, "PAGAMENTO_NO_PRAZO"),
    ("dias", DIAS, "PAGAMENTO_ANTECIPADO"),
    ("vlr", VLR, "PAGAMENTO_INSUFICIENTE"),
    ("vlr", VLR, "PAGAMENTO_TOTAL"),
    ("vlr", VLR, "PAGAMENTO_PARCIAL"),
]
MONTHS = [1, 3, 6, 9, 12]


def _exact_sum() -> str:
    total = "cast(0 as double)"
    for i in reversed(range(5)):
        total = f"({total} / 16777216 + cast(sum(cast(p{i} as bigint)) {{f}} as double))"
    return f"{total} * 16777216"


def _slots() -> list[tuple[str, str, str]]:
    """(measure, aggregate, SQL with a {f} filter placeholder) in numbering order."""
    out = []
    for measure, source in (
        ("fvl_valor_fatura", "valor_fatura"),
        ("fvl_valor_pagamento_minimo", "valor_pagamento_minimo"),
        ("fvl_valor_pagamento", "valor_pagamento"),
    ):
        cents = f"sum(cast({source} * 100 as bigint)) {{f}}"
        n = f"count({source}) {{f}}"
        out += [
            (measure, "SUM", f"cast(sum({source}) {{f}} as double)"),
            # half-up at six decimals, in whole numbers
            (measure, "AVG",
             f"cast(({cents} * 20000 + {n}) // (2 * nullif({n}, 0)) as double) / 1000000"),
            (measure, "MAX", f"cast(max({source}) {{f}} as double)"),
            (measure, "MIN", f"cast(min({source}) {{f}} as double)"),
        ]
    late, pct = "fvl_numero_dias_atraso", "fvl_pct_fatura_pgto"
    out += [
        (late, "AVG", "avg(atraso) {f}"),
        (late, "MAX", "cast(max(atraso) {f} as bigint)"),
        (late, "MIN", "cast(min(atraso) {f} as bigint)"),
        ("fvl_qtd_transacao", "SUM", "cast(sum(1) {f} as bigint)"),
        (pct, "AVG", f"{_exact_sum()} / count(pct) {{f}}"),
        (pct, "MAX", "round(max(pct) {f}, 4)"),
        (pct, "MIN", "round(min(pct) {f}, 4)"),
    ]
    return out


def _blocks(documented: bool = False, classes=tuple(CLASSES), windows=tuple(MONTHS)):
    """(number, class expression, class column, class, measure, months, aggregate, SQL)."""
    number = 0
    slots = _slots()
    measures = list(dict.fromkeys(m for m, _, _ in slots))
    for expression, column, label in classes:
        for measure in measures:
            if documented and measure == "fvl_pct_fatura_pgto" and label in (
                "SEM_PAGAMENTO", "PAGAMENTO_TOTAL",
            ):
                continue
            for months in windows:
                for m, aggregate, sql in slots:
                    if m != measure or (documented and months == 1 and aggregate != "SUM"):
                        continue
                    number += 1
                    yield number, expression, column, label, measure, months, aggregate, sql


def _window(months: int, up_to_reference: bool = False) -> str:
    test = f"data_emissao >= {REF} - interval {months} month"
    return test + (f" and data_emissao <= {REF}" if up_to_reference else "")


def _loaded_text(literal: bool) -> str:
    """Raw tables as the load jobs make them of the text, payments with malformed values."""
    number = "substring(id_fatura, 3, 2)" if literal else "split_part(id_fatura, '-', 2)"
    day = _january if literal else "try_cast({} as date)".format
    pay = RAW.split("pay as (", 1)[1]
    return TEXT + RAW.removeprefix(ORDERS).replace("inv as (", "inv0 as (", 1).split("pay as (", 1)[0] + f"""
inv as (
  select try_cast({number} as bigint) as id_fatura, try_cast(id_cliente as bigint) as id_cliente,
         '{LOAD_1}' as dt_proc, {day("data_emissao")} as data_emissao, {day("data_vencimento")} as data_vencimento,
         cast(valor_fatura as decimal(15,2)) as valor_fatura,
         cast(valor_pagamento_minimo as decimal(15,2)) as valor_pagamento_minimo,
         cast(substring(replace(data_emissao, '-', ''), 1, 6) as int) as ref
  from txt
),
pay0 as ({pay},
pay as (
  select id_pagamento, id_fatura, id_cliente, '{LOAD_1}' as dt_proc, data_pagamento,
         case when cast(id_pagamento as bigint) % 5 <> 0 then valor_pagamento end as valor_pagamento, ref
  from pay0 where cast(id_pagamento as bigint) % 7 <> 0
)"""


def _book(
    documented: bool = False, up_to_reference: bool = False, literal: bool = False, raw: str = RAW, **some
) -> str:
    columns = []
    for number, expression, _, label, _, months, _, sql in _blocks(documented, **some):
        f = f"filter (where {expression} = '{label}' and {_window(months, up_to_reference)})"
        columns.append(f"{sql.format(f=f)} as VAR_{number}")
    return (
        "with " + _variables(IN_RANGE, _literal_dedup if literal else _latest, literal, raw)
        + f"\nselect id_cliente, cast(200002 as bigint) as ref, '{RUN}' as dt_proc,\n"
        + ",\n".join(columns)
        + "\nfrom vars group by id_cliente"
    )


def _long() -> str:
    """CTEs ending in `long`: one row per customer and variable that has a value."""
    slots = _slots()
    names = ",\n".join(
        f"('VAR_{n}', '{column}', '{label}', '{measure}', {months}, '{aggregate}')"
        for n, _, column, label, measure, months, aggregate, _ in _blocks()
    )
    cells = "\nunion all\n".join(
        f"select id_cliente, '{column}' as class_column, '{label}' as class_value, w as months, "
        "valor_fatura, valor_pagamento_minimo, valor_pagamento, atraso, pct, p0, p1, p2, p3, p4 "
        f"from vars, (values (1), (3), (6), (9), (12)) t(w) "
        f"where {expression} = '{label}' and data_emissao >= {REF} - to_months(w)"
        for expression, column, label in CLASSES
    )
    aggregates = ", ".join(f"{sql.format(f='')} as s{i}" for i, (_, _, sql) in enumerate(slots))
    melted = "\nunion all\n".join(
        f"select id_cliente, class_column, class_value, months, '{m}' as measure, "
        f"'{a}' as aggregate, cast(s{i} as double) as value from agg"
        for i, (m, a, _) in enumerate(slots)
    )
    return _variables(IN_RANGE) + f""",
names(variable, class_column, class_value, measure, months, aggregate) as (values {names}),
cells as ({cells}),
agg as (select id_cliente, class_column, class_value, months, {aggregates}
        from cells group by id_cliente, class_column, class_value, months),
melted as ({melted}),
long as (
  select id_cliente, variable, class_column, class_value, measure,
         cast(months as bigint) as months, aggregate, value
  from melted join names using (class_column, class_value, measure, months, aggregate)
  where value is not null
)"""


def _show(columns: str, body: str, source: str) -> str:
    return f"with {body}\nselect {columns} from {source}"


def _control(table: str, runs: str) -> str:
    """One audit row per run; an order without a customer or hyphen cannot be used."""
    bad = "id_cliente is null or o_orderpriority = '4-NOT SPECIFIED'"
    return (
        f"with {ORDERS} select '{table}' as tb_name, dt_proc, count(*) as qtd_registros, "
        f"count(*) filter (where {bad}) as qtd_rejeitados from ord, {runs} group by dt_proc"
    )


def _standardized(number: str, issued: str, due: str, run: str = RUN, source: str = "txt") -> str:
    return f"""with {LINES}
select {number} as id_fatura,
       try_cast(id_cliente as bigint) as id_cliente,
       '{run}' as dt_proc,
       try_cast(substring(replace(data_emissao, '-', ''), 1, 6) as bigint) as ref,
       strftime({issued}, '%Y-%m-%d') as data_emissao,
       strftime({due}, '%Y-%m-%d') as data_vencimento,
       cast(cast(valor_fatura as decimal(15,2)) as double) as valor_fatura,
       cast(cast(valor_pagamento_minimo as decimal(15,2)) as double) as valor_pagamento_minimo
from {source}"""


def _rejected_rows(source: str, run: str) -> str:
    """Rows of a text table without a key, as rejects."""
    return _standardized(
        "try_cast(split_part(id_fatura, '-', 2) as bigint)",
        "try_cast(data_emissao as date)",
        "try_cast(data_vencimento as date)", run, source,
    )


NO_KEY = "id_cliente is null or id_fatura is null"


def _january(column: str) -> str:
    day = f"try_cast({column} as date)"
    return f"make_date(year({day}), 1, day({day}))"


def _pair(column: str, source: str) -> str:
    return f"""id_fatura, id_cliente, strftime(data_vencimento, '%Y-%m-%d') as data_vencimento,
  strftime(data_pagamento, '%Y-%m-%d') as data_pagamento, {source} as {column}"""


def _amounts(column: str, source: str) -> str:
    return f"""id_fatura, id_cliente, cast(valor_fatura as double) as valor_fatura,
  cast(valor_pagamento_minimo as double) as valor_pagamento_minimo,
  cast(valor_pagamento as double) as valor_pagamento, {source} as {column}"""


FLAGS = ", ".join(
    f"cast(case when {_window(n)} then 1 else 0 end as bigint) as flg_u{n}m" for n in MONTHS
)

ORACLE: dict[str, str] = {
    "extract_snapshot": f"with {TEXT}\nselect * from txt",
    "extract_equal_depth": f"with {RAW} select id_cliente, count(*) as linhas, 1 as partes from inv group by id_cliente",
    "raw_invoices": _standardized(
        "try_cast(split_part(id_fatura, '-', 2) as bigint)",
        "try_cast(data_emissao as date)",
        "try_cast(data_vencimento as date)",
    ),
    "raw_invoices_as_written": _standardized(
        "try_cast(substring(id_fatura, 3, 2) as bigint)",
        _january("data_emissao"),
        _january("data_vencimento"),
    ),
    "raw_payments": f"""with {RAW}
select 'P' || id_pagamento as id_pagamento, id_fatura, id_cliente, '{RUN}' as dt_proc,
       cast(ref as bigint) as ref, strftime(data_pagamento, '%Y-%m-%d') as data_pagamento,
       cast(valor_pagamento as double) as valor_pagamento
from pay""",
    "scan_raw_range": _show(INV_SHOWN, RAW, f"inv where {IN_RANGE}"),
    "control_row": _control("faturas", f"(values ('{RUN}')) t(dt_proc)"),
    "control_row_csv": _control("faturas", f"(values ('{RUN}')) t(dt_proc)"),
    "daily_load_stream_audit": _control(
        "faturas", f"(values ('{LOAD_1}'), ('{LOAD_2}'), ('{LOAD_3}')) t(dt_proc)"
    ),
    "daily_load_stream_latest": _standardized(
        "try_cast(split_part(id_fatura, '-', 2) as bigint)",
        "try_cast(data_emissao as date)",
        "try_cast(data_vencimento as date)", LOAD_3,
    ) + " where id_cliente is not null and split_part(id_fatura, '-', 2) <> ''",
    "daily_load_stream": f"""with {RAW}
select dt_proc, cast(ref as bigint) as ref, count(*) as qtd, cast(sum(valor_fatura) as double) as total
from (select ref, cast(valor_fatura as decimal(15,2)) as valor_fatura from inv where dt_proc = '{LOAD_1}'),
     (values ('{LOAD_1}'), ('{LOAD_2}'), ('{LOAD_3}')) t(dt_proc)
group by dt_proc, ref""",
    "adhoc_sql": f"""with {_variables(IN_RANGE)},
e as (select ref, count(*) as faturas, cast(sum(valor_fatura) as double) as faturado from inv group by ref),
p as (select ref, count(*) as pagamentos, cast(sum(valor_pagamento) as double) as pago from pay group by ref)
select cast(ref as bigint) as ref, faturas, faturado, pagamentos, pago,
       case when ref = 200002 then (select count(*) from vars) end as linhas,
       case when ref = 200002 then (select count(distinct id_cliente) from vars) end as clientes
from e full join p using (ref)""",
    "write_read_append": _show(INV_SHOWN, RAW, "inv"),
    "write_read_overwrite": _show(INV_SHOWN, RAW, f"inv where dt_proc = '{LOAD_2}'"),
    "write_read_replace_months": _show(
        INV_SHOWN, RAW,
        f"inv where case when {IN_RANGE} then dt_proc = '{LOAD_2}' else dt_proc = '{LOAD_1}' end",
    ),
    "clustered_invoices": _show(INV_SHOWN, RAW, "inv"),
    "invoices_of_customers": _show(
        INV_SHOWN, RAW + """,
best as (
  select id_cliente, sum(valor_fatura) as total from inv where id_cliente is not null
  group by id_cliente order by total desc, id_cliente limit 10
)""", "inv where id_cliente in (select id_cliente from best)",
    ),
    "latest_key": _show(
        "id_cliente, id_fatura, max(cast(ref as varchar) || dt_proc) as max_dedup_key", RAW,
        "pay group by id_cliente, id_fatura",
    ),
    "dedup_invoices": _show(INV_SHOWN, RAW + "," + _latest("d", "inv"), "d"),
    "dedup_payments": _show(PAY_SHOWN, RAW + "," + _latest("d", "pay"), "d"),
    "dedup_payments_salted": _show(PAY_SHOWN, RAW + "," + _latest("d", "pay"), "d"),
    "dedup_invoices_as_written": _show(INV_SHOWN, RAW + "," + _literal_dedup("d", "inv"), "d"),
    "dedup_payments_as_written": _show(PAY_SHOWN, RAW + "," + _literal_dedup("d", "pay"), "d"),
    "rejected_invoices": "select *, 'sem chave' as motivo from (" + _standardized(
        "try_cast(split_part(id_fatura, '-', 2) as bigint)",
        "try_cast(data_emissao as date)",
        "try_cast(data_vencimento as date)",
    ) + ") where id_cliente is null or id_fatura is null",
    "rejected_lines": f"""select *, 'sem chave' as motivo, cast(null as varchar) as linha
from ({_rejected_rows("lin where kind > 3", LOAD_1)}) where {NO_KEY}
union all by name
select '{LOAD_1}' as dt_proc, 'linha malformada' as motivo, linha from (with {LINES} select linha from lin where kind <= 3)""",
    "loaded_lines": _rejected_rows("lin where kind > 3", LOAD_1),
    "rejected_lines_audit": f"""with {LINES}
select 'faturas' as tb_name, '{LOAD_1}' as dt_proc, count(*) filter (where kind > 3) as qtd_registros,
       count(*) filter (where kind <= 3 or id_cliente is null or not contains(id_fatura, '-')) as qtd_rejeitados,
       count(*) as linhas
from lin""",
    "rejected_after_overwrite": f"""select *, 'sem chave' as motivo, cast(null as varchar) as linha
from ({_rejected_rows("txt", LOAD_2)}) where {NO_KEY}""",
    "daily_load_stream_rejects": f"""with {LINES}
select 'faturas' as tb_name, dt_proc, count(*) filter (where kind > 3) as qtd_registros,
       count(*) filter (where kind <= 3 or id_cliente is null or not contains(id_fatura, '-')) as qtd_rejeitados,
       count(*) filter (where kind <= 3) as malformadas
from lin, (values ('{LOAD_1}'), ('{LOAD_2}')) t(dt_proc) group by dt_proc""",
    "invoice_payment_join": _show(
        """id_fatura, id_cliente, strftime(data_emissao, '%Y-%m-%d') as data_emissao,
  strftime(data_vencimento, '%Y-%m-%d') as data_vencimento,
  cast(valor_fatura as double) as valor_fatura,
  cast(valor_pagamento_minimo as double) as valor_pagamento_minimo,
  strftime(data_pagamento, '%Y-%m-%d') as data_pagamento,
  cast(valor_pagamento as double) as valor_pagamento""",
        _joined(), "joined",
    ),
    "invoice_payment_join_salted": _show(
        """id_fatura, id_cliente, strftime(data_emissao, '%Y-%m-%d') as data_emissao,
  strftime(data_vencimento, '%Y-%m-%d') as data_vencimento,
  cast(valor_fatura as double) as valor_fatura,
  cast(valor_pagamento_minimo as double) as valor_pagamento_minimo,
  strftime(data_pagamento, '%Y-%m-%d') as data_pagamento,
  cast(valor_pagamento as double) as valor_pagamento""",
        _joined(), "joined",
    ),
    "days_class": _show(_pair(DIAS, "dias"), _variables(), "vars"),
    "days_late": _show(
        _pair("fvl_numero_dias_atraso", "cast(atraso as bigint)"), _variables(), "vars"
    ),
    "value_class": _show(_amounts(VLR, "vlr"), _variables(), "vars"),
    "pct_paid": _show(_amounts("fvl_pct_fatura_pgto", "round(pct, 4)"), _variables(), "vars"),
    "pct_paid_as_written": _show(
        _amounts("fvl_pct_fatura_pgto", "round(pct, 4)"), _variables(literal_pct=True), "vars"
    ),
    "window_flags": _show(
        f"id_fatura, id_cliente, strftime(data_emissao, '%Y-%m-%d') as data_emissao, {FLAGS}",
        RAW + "," + _latest("d", "inv"), "d",
    ),
    "stage": "with " + _variables(IN_RANGE) + "\n" + STAGE_SHOWN,
    "stage_by_payment": "with " + _variables(IN_RANGE, _by_payment) + "\n" + STAGE_SHOWN,
    "stage_as_written": "with " + _variables(IN_RANGE, _literal_dedup, literal_pct=True) + "\n" + STAGE_SHOWN,
    "book": _book(),
    "book_documented": _book(documented=True),
    "book_up_to_reference": _book(up_to_reference=True),
    "book_from_text": _book(raw=_loaded_text(False)),
    "book_as_written": _book(literal=True, raw=_loaded_text(True)),
    "book_long": "with " + _long() + f"""
select id_cliente, cast(200002 as bigint) as ref, '{RUN}' as dt_proc, variable, class_column, class_value,
       measure, months, aggregate,
       case when measure = 'fvl_pct_fatura_pgto' and aggregate <> 'AVG' then round(value, 4) else value end as value
from long""",
    "book_catalog": "with " + _long() + """
select variable, n.class_column, n.class_value, n.measure, cast(n.months as bigint) as months,
       n.aggregate, count(l.value) as clientes
from names n left join long l using (variable)
group by variable, n.class_column, n.class_value, n.measure, n.months, n.aggregate""",
}


def _at(sql: str, year: int, month: int) -> str:
    """A query of the reference date as one of the first day of another month."""
    last, first = year * 100 + month, (year - 1) * 100 + month
    sql = sql.replace(REF, f"date '{year}-{month:02}-01'")
    return re.sub(rf"\b{FIRST}\b", str(first), re.sub(rf"\b{LAST}\b", str(last), sql))


# The same rows, by other ways.
ORACLE |= {
    "dedup_invoices_bucketed": ORACLE["dedup_invoices"],
    "dedup_payments_bucketed": ORACLE["dedup_payments"],
    "invoice_payment_join_bucketed": ORACLE["invoice_payment_join"],
    "books_of_a_year": "\nunion all\n".join(
        f"select * from ({_at(_book(classes=CLASSES[:2], windows=(3, 12)), 1999 + (m > 12), m - 12 * (m > 12))})"
        for m in range(3, 15)
    ),
    # Customers of the third load have the run that refreshed them.
    "book_refreshed": f"""with {RAW}
select * replace (case when id_cliente in (select id_cliente from pay where dt_proc = '{LOAD_3}' and {IN_RANGE})
                  then '20000205220000' else dt_proc end as dt_proc)
from ({_book()})""",
}
