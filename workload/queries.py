"""One query per operator of the library, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billbook.config import AS_WRITTEN, BY_CUSTOMER, INTENDED, Zones, month_bounds
from billbook.functions.calendar import window_flags
from billbook.functions.payment import LATE, UNPAID
from billbook.operators.dedup import latest_key
from billbook.operators.standardize import standardize_invoices, standardize_payments
from billbook.plans.book import book_schema, feature_book, feature_book_long
from billbook.plans.books import feature_books
from billbook.plans.jobs import book_job, extract_job, load_job
from billbook.plans.refresh import book_by_slices, keep_history, read_sliced, refresh_book
from billbook.plans.spec import BookSpec, catalog
from billbook.plans.stage import (
    AMOUNT, TIMING, build_stage, latest_joined, latest_versions, payment_variables,
)
from billbook.session import scratch_dir
from billbook.schema import CONTROL, INVOICE_KEYS, LINE, RAW
from billbook.sinks.clustered import cluster, read_customers
from billbook.sinks.lake import replace_months, write_month, write_months, write_raw, write_run
from billbook.sinks.versions import update_versions, versions_joined, versions_table
from billbook.sources.database import equal_depth_predicates
from billbook.sources.ingestion import extract_snapshot, read_ingestion, read_lines
from billbook.sources.lake import in_months, read_look_back, read_raw, read_rejects, read_stage, register_zones
from billbook.streaming.daily_load import audit_arrivals, load_arrivals, reject_arrivals
from workload import billing
from workload.billing import LOADS, REF_DATE, RUN_TS

Query = Callable[[SparkSession, str], DataFrame]

BY_PAYMENT = (*INVOICE_KEYS, "id_pagamento")


def present(df: DataFrame) -> DataFrame:
    """Types that any engine compares alike: exact ones as double, dates as text, ints as bigint."""
    shown = {
        T.DecimalType: "cast({0} as double)",
        T.FloatType: "round(cast({0} as double), 4)",
        T.DateType: "date_format({0}, 'yyyy-MM-dd')",
        T.IntegerType: "cast({0} as bigint)",
    }
    return df.selectExpr(
        *[shown.get(type(f.dataType), "{0}").format(f.name) + f" as {f.name}" for f in df.schema]
    )


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_raw(spark, billing.lake(spark, sf_dir, (name,)), name)


def _fresh(spark: SparkSession) -> Zones:
    return Zones(scratch_dir(spark, "run"))


# Sources and sinks


def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _fresh(spark)
    extract_snapshot(billing.invoice_text(spark, sf_dir), zones, "tb_faturas", LOADS[0])
    return read_ingestion(spark, zones, "tb_faturas")


def extract_equal_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read in parts of equal depth, as a database would be: per customer its rows and the parts they are in."""
    table = billing.invoices(spark, sf_dir)
    parts = [
        table.where(p).select("id_cliente", F.lit(i).alias("part"))
        for i, p in enumerate(equal_depth_predicates(table, "id_cliente", 6))
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("id_cliente").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct("part").alias("partes")
    )


def raw_invoices(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(standardize_invoices(extract(spark, sf_dir), RUN_TS, mode))

    return query


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _fresh(spark)
    extract_snapshot(billing.payment_text(spark, sf_dir), zones, "tb_pagamentos", LOADS[0])
    return present(standardize_payments(read_ingestion(spark, zones, "tb_pagamentos"), RUN_TS))


def scan_raw_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(read_look_back(spark, billing.lake(spark, sf_dir, ("faturas",)), "faturas", REF_DATE))


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _fresh(spark)
    extract_snapshot(billing.invoice_text(spark, sf_dir), zones, "tb_faturas", LOADS[0])
    load_job(spark, zones, "tb_faturas", RUN_TS)
    return spark.read.schema(CONTROL).parquet(zones.control("faturas"))


def control_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit as text without a header, in a table of another name."""
    zones = _fresh(spark)
    extract_snapshot(billing.invoice_text(spark, sf_dir), zones, "tb_faturas", LOADS[0])
    load_job(spark, zones, "tb_faturas", RUN_TS, control_format="csv", control_table="cargas")
    return spark.read.schema(CONTROL).csv(zones.control("cargas"))


def daily_load_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days of arrivals in two calls, the second picking up only the new ones."""
    zones = _streamed(spark, sf_dir)
    loaded = read_raw(spark, zones, "faturas")
    return loaded.groupBy("dt_proc", "ref").agg(
        F.count(F.lit(1)).alias("qtd"), F.sum("valor_fatura").cast("double").alias("total")
    ).withColumn("ref", F.col("ref").cast("bigint"))


def _streamed(spark: SparkSession, sf_dir: str) -> Zones:
    """A first call with one snapshot, then one with two that wait; audited twice, which adds nothing."""
    zones = _fresh(spark)
    text = billing.invoice_text(spark, sf_dir)
    for runs in (LOADS[:1], LOADS[1:]):
        for run_ts in runs:
            extract_snapshot(text, zones, "tb_faturas", run_ts)
        load_arrivals(spark, zones, "tb_faturas").awaitTermination()
        audit_arrivals(spark, zones, "tb_faturas")
    audit_arrivals(spark, zones, "tb_faturas")
    return zones


def daily_load_stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three full snapshots are one invoice each after deduplication."""
    return present(latest_versions(read_raw(spark, _streamed(spark, sf_dir), "faturas")))


def daily_load_stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(CONTROL).parquet(_streamed(spark, sf_dir).control("faturas"))


def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = billing.lake(spark, sf_dir)
    stage = written_stage(spark, sf_dir)
    month = month_bounds(REF_DATE)[1]
    billing.once(
        spark, sf_dir, "book",
        lambda: write_month(feature_book(stage, BookSpec(), REF_DATE), zones.curated("book"), month),
    )
    register_zones(spark, zones, "lake")
    return spark.sql("""
        with emitido as (
            select ref, count(*) as faturas, cast(sum(valor_fatura) as double) as faturado
            from lake.faturas group by ref
        ), pago as (
            select ref, count(*) as pagamentos, cast(sum(valor_pagamento) as double) as pago
            from lake.pagamentos group by ref
        ), estagio as (
            select ref, count(*) as linhas from lake.stage where ref between 200001 and 200002 group by ref
        ), livro as (
            select ref, count(*) as clientes from lake.book where ref between 200001 and 200002 group by ref
        )
        select cast(ref as bigint) as ref, faturas, faturado, pagamentos, pago, linhas, clientes
        from emitido full join pago using (ref) left join estagio using (ref) left join livro using (ref)
    """)


def write_read_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, the second repeated: a repeated load replaces itself."""
    zones = _fresh(spark)
    path, rows = zones.raw("faturas"), billing.invoices(spark, sf_dir)
    for run_ts in (LOADS[0], LOADS[1], LOADS[1]):
        write_raw(rows.where(F.col("dt_proc") == run_ts), path, "append")
    return present(read_raw(spark, zones, "faturas"))


def write_read_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _fresh(spark)
    path, rows = zones.raw("faturas"), billing.invoices(spark, sf_dir)
    write_raw(rows.where(F.col("dt_proc") == LOADS[0]), path, "overwrite")
    write_raw(rows.where(F.col("dt_proc") == LOADS[1]), path, "overwrite")
    return present(read_raw(spark, zones, "faturas"))


def write_read_replace_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months of the first load, then the look-back months of the second in their place."""
    path = _fresh(spark).raw("faturas")
    rows = billing.invoices(spark, sf_dir)
    write_months(rows.where(F.col("dt_proc") == LOADS[0]), path, "append")
    second = in_months(rows.where(F.col("dt_proc") == LOADS[1]), *month_bounds(REF_DATE))
    replace_months(second, path)
    return present(spark.read.parquet(path))


def _clustered(spark: SparkSession, sf_dir: str) -> Zones:
    zones = billing.lake(spark, sf_dir, ("faturas",))
    billing.once(spark, sf_dir, "clustered", lambda: cluster(spark, zones, "faturas", rows_per_file=20_000))
    return zones


def clustered_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy of the raw invoices that is clustered by customer, as a table of SQL."""
    register_zones(spark, _clustered(spark, sf_dir), "lake", ("faturas" + BY_CUSTOMER,))
    names = ", ".join(RAW["faturas"].names)
    return present(spark.sql(f"select {names} from lake.faturas{BY_CUSTOMER}"))


def invoices_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All invoices of the ten customers with the highest sum of invoices, looked up in the clustered copy."""
    total = _raw(spark, sf_dir, "faturas").where("id_cliente is not null").groupBy("id_cliente").agg(
        F.sum("valor_fatura").alias("total")
    )
    top = [r["id_cliente"] for r in total.orderBy(F.desc("total"), "id_cliente").limit(10).collect()]
    return present(read_customers(spark, _clustered(spark, sf_dir), "faturas", top))


# Deduplication and join


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_key(_raw(spark, sf_dir, "pagamentos"))


def dedup(name: str, mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(latest_versions(_raw(spark, sf_dir, name), mode))

    return query


def rejected_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the load job found unusable, read from the table it wrote."""
    zones = _fresh(spark)
    extract_snapshot(billing.invoice_text(spark, sf_dir), zones, "tb_faturas", LOADS[0])
    load_job(spark, zones, "tb_faturas", RUN_TS)
    return present(read_rejects(spark, zones, "faturas").drop(LINE))


def _lines_loaded(spark: SparkSession, sf_dir: str, run_ts: str = LOADS[0], zones: Zones | None = None) -> Zones:
    zones = zones or _fresh(spark)
    billing.write_lines(billing.invoice_lines(spark, sf_dir), zones.ingestion_run("tb_faturas", run_ts))
    load_job(spark, zones, "tb_faturas", run_ts, snapshot_ts=run_ts)
    return zones


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects of a snapshot with malformed lines: those lines, and rows without a key."""
    return present(read_rejects(spark, _lines_loaded(spark, sf_dir), "faturas"))


def loaded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What such a snapshot leaves in the raw table."""
    return present(read_raw(spark, _lines_loaded(spark, sf_dir), "faturas"))


def rejected_lines_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the snapshot are rows loaded and malformed lines; the latter count as rejected."""
    zones = _lines_loaded(spark, sf_dir)
    lines = read_lines(spark, zones, "tb_faturas").agg(F.count(F.lit(1)).alias("linhas"))
    return spark.read.schema(CONTROL).parquet(zones.control("faturas")).join(F.broadcast(lines))


def rejected_after_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects after a load that replaces the table: none of the load before."""
    zones = _lines_loaded(spark, sf_dir)
    extract_snapshot(billing.invoice_text(spark, sf_dir), zones, "tb_faturas", LOADS[1])
    load_job(spark, zones, "tb_faturas", LOADS[1], write_mode="overwrite")
    return present(read_rejects(spark, zones, "faturas"))


def daily_load_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of arrivals with malformed lines in two calls: per run, what the audit and the rejects say."""
    zones = _fresh(spark)
    for run_ts in LOADS[:2]:
        billing.write_lines(billing.invoice_lines(spark, sf_dir), zones.ingestion_run("tb_faturas", run_ts))
        for stream in (load_arrivals, reject_arrivals):
            stream(spark, zones, "tb_faturas").awaitTermination()
        audit_arrivals(spark, zones, "tb_faturas")
    lines = read_rejects(spark, zones, "faturas").groupBy("dt_proc").agg(F.count(LINE).alias("malformadas"))
    return spark.read.schema(CONTROL).parquet(zones.control("faturas")).join(lines, "dt_proc")


def _joined(spark: SparkSession, sf_dir: str, mode: str = INTENDED) -> DataFrame:
    return latest_joined(
        _raw(spark, sf_dir, "faturas"), _raw(spark, sf_dir, "pagamentos"), mode
    )


def invoice_payment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_joined(spark, sf_dir))


# Far below the library's 10 million, so that whole tables of any size here have hot keys.
FEW_ROWS = 3


def invoice_payment_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every invoice with more than FEW_ROWS rows or payments is split and copied."""
    joined = latest_joined(
        _raw(spark, sf_dir, "faturas"), _raw(spark, sf_dir, "pagamentos"), rows_per_task=FEW_ROWS
    )
    return present(joined)


def dedup_payments_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(latest_versions(_raw(spark, sf_dir, "pagamentos"), rows_per_task=FEW_ROWS))


BUCKETS = 8


# Runs brought in out of order, one of the payments' twice.
ARRIVALS = {"faturas": (LOADS[1], LOADS[0]), "pagamentos": (LOADS[1], LOADS[0], LOADS[2], LOADS[0])}


def _kept_bucketed(spark: SparkSession, sf_dir: str, *names: str) -> Zones:
    """The lake with the tables of latest versions that are asked for."""
    zones = billing.lake(spark, sf_dir, names)

    def update(name: str) -> None:
        for run_ts in ARRIVALS[name]:
            update_versions(spark, zones, name, run_ts, BUCKETS)

    for name in names:
        billing.once(spark, sf_dir, f"versions {name}", lambda: update(name))  # noqa: B023
    return zones


def dedup_bucketed(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        held = spark.table(versions_table(spark, _kept_bucketed(spark, sf_dir, name), name, BUCKETS))
        return present(held.select(*RAW[name].names))

    return query


def invoice_payment_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(versions_joined(spark, _kept_bucketed(spark, sf_dir, *ARRIVALS), BUCKETS))


# Stage variables

_PAIR = ("id_fatura", "id_cliente", "data_vencimento", "data_pagamento")
_AMOUNTS = ("id_fatura", "id_cliente", "valor_fatura", "valor_pagamento_minimo", "valor_pagamento")


def variable(*columns: str, mode: str = INTENDED) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = payment_variables(_joined(spark, sf_dir), REF_DATE, mode).select(*columns)
        if "fvl_pct_fatura_pgto" in columns:
            found = found.withColumn("fvl_pct_fatura_pgto", F.col("fvl_pct_fatura_pgto").cast("float"))
        return present(found)

    return query


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_versions(_raw(spark, sf_dir, "faturas"))
    marks = window_flags(F.col("data_emissao"), REF_DATE)
    return present(
        rows.select("id_fatura", "id_cliente", "data_emissao", *[c.alias(n) for n, c in marks.items()])
    )


def _stage(spark: SparkSession, zones: Zones, mode: str = INTENDED) -> DataFrame:
    return build_stage(
        read_look_back(spark, zones, "faturas", REF_DATE),
        read_look_back(spark, zones, "pagamentos", REF_DATE),
        REF_DATE,
        RUN_TS,
        mode,
    )


def stage_by_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions are told apart by payment, so all instalments of an invoice stay."""
    zones = billing.lake(spark, sf_dir)
    return present(build_stage(
        read_look_back(spark, zones, "faturas", REF_DATE),
        read_look_back(spark, zones, "pagamentos", REF_DATE),
        REF_DATE, RUN_TS, payment_keys=BY_PAYMENT,
    ))


def stage(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(_stage(spark, billing.lake(spark, sf_dir), mode))

    return query


# Book


def written_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage as the book job sees it: read back from its files, written once per session."""
    zones, month = billing.lake(spark, sf_dir), month_bounds(REF_DATE)[1]
    billing.once(spark, sf_dir, "stage", lambda: write_month(_stage(spark, zones), zones.curated("stage"), month))
    return read_stage(spark, zones, month, RUN_TS)


def book(spec: BookSpec) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(feature_book(written_stage(spark, sf_dir), spec, REF_DATE))

    return query


def _from_text(spark: SparkSession, sf_dir: str, mode: str) -> Zones:
    """All jobs of a run in order, from extract to book; each load is run twice, as a retry would."""
    zones = _fresh(spark)
    for name, text in (("tb_faturas", billing.invoice_text), ("tb_pagamentos", billing.malformed_payment_text)):
        extract_job(text(spark, sf_dir), zones, name, LOADS[0])
        for _ in range(2):
            load_job(spark, zones, name, LOADS[0], mode=mode)
    book_job(spark, zones, REF_DATE, RUN_TS, mode=mode)
    return zones


def book_from_text(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        zones = _from_text(spark, sf_dir, mode)
        schema = book_schema(BookSpec())
        return present(spark.read.schema(schema).parquet(zones.curated("book")))

    return query


SLICES = 8
LATE_RUN = "20000205220000"


def book_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A book of two loads, refreshed for the customers of the third."""
    zones = _fresh(spark)
    tables = {"faturas": billing.invoices(spark, sf_dir), "pagamentos": billing.payments(spark, sf_dir)}

    def load(run_ts: str) -> None:
        for name, rows in tables.items():
            write_run(rows.where(F.col("dt_proc") == run_ts), zones.raw(name), run_ts)
            keep_history(spark, zones, name, run_ts, SLICES)

    load(LOADS[0])
    load(LOADS[1])
    book_by_slices(spark, zones, REF_DATE, RUN_TS, SLICES)
    load(LOADS[2])
    refresh_book(spark, zones, REF_DATE, LATE_RUN, [LOADS[2]], SLICES)
    held = read_sliced(spark, zones, "book", book_schema(BookSpec()), SLICES).drop("fatia")
    return present(held)


def _twelve_months() -> list[str]:
    """The reference date and the same day of the eleven months before."""
    return [f"1999-{m:02}-01" for m in range(3, 13)] + ["2000-01-01", REF_DATE]


def books_of_a_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve monthly books of the unpaid and the late from one scan of each raw table."""
    tables = [_raw(spark, sf_dir, n) for n in ("faturas", "pagamentos")]
    spec = BookSpec(classes=((TIMING, (UNPAID, LATE)),), windows=(3, 12))
    return present(feature_books(*tables, _twelve_months(), RUN_TS, spec))


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_book_long(written_stage(spark, sf_dir), BookSpec(), REF_DATE)


def book_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The greatest and least percentages are shown as the wide book's, averages as they are.
    shown = (F.col("measure") == "fvl_pct_fatura_pgto") & (F.col("aggregate") != "AVG")
    return (
        _long(spark, sf_dir)
        .withColumn("value", F.when(shown, F.round("value", 4)).otherwise(F.col("value")))
        .withColumn("months", F.col("months").cast("bigint"))
    )


def book_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every variable of the book with the number of customers that have a value."""
    filled = _long(spark, sf_dir).groupBy("variable").agg(F.count(F.lit(1)).alias("clientes"))
    return (
        catalog(spark)
        .join(filled, "variable", "left")
        .withColumn("clientes", F.coalesce("clientes", F.lit(0)).cast("bigint"))
        .withColumn("months", F.col("months").cast("bigint"))
    )


QUERIES: dict[str, Query] = {
    "extract_snapshot": extract,
    "extract_equal_depth": extract_equal_depth,
    "raw_invoices": raw_invoices(INTENDED),
    "raw_invoices_as_written": raw_invoices(AS_WRITTEN),
    "raw_payments": raw_payments,
    "scan_raw_range": scan_raw_range,
    "control_row": control,
    "control_row_csv": control_csv,
    "daily_load_stream": daily_load_stream,
    "daily_load_stream_latest": daily_load_stream_latest,
    "daily_load_stream_audit": daily_load_stream_audit,
    "adhoc_sql": adhoc_sql,
    "write_read_append": write_read_append,
    "write_read_overwrite": write_read_overwrite,
    "write_read_replace_months": write_read_replace_months,
    "clustered_invoices": clustered_invoices,
    "invoices_of_customers": invoices_of_customers,
    "latest_key": latest,
    "dedup_invoices": dedup("faturas", INTENDED),
    "dedup_payments": dedup("pagamentos", INTENDED),
    "dedup_invoices_as_written": dedup("faturas", AS_WRITTEN),
    "dedup_payments_as_written": dedup("pagamentos", AS_WRITTEN),
    "rejected_invoices": rejected_invoices,
    "rejected_lines": rejected_lines,
    "loaded_lines": loaded_lines,
    "rejected_lines_audit": rejected_lines_audit,
    "rejected_after_overwrite": rejected_after_overwrite,
    "daily_load_stream_rejects": daily_load_stream_rejects,
    "invoice_payment_join_salted": invoice_payment_join_salted,
    "dedup_payments_salted": dedup_payments_salted,
    "invoice_payment_join": invoice_payment_join,
    "dedup_invoices_bucketed": dedup_bucketed("faturas"),
    "dedup_payments_bucketed": dedup_bucketed("pagamentos"),
    "invoice_payment_join_bucketed": invoice_payment_join_bucketed,
    "days_class": variable(*_PAIR, TIMING),
    "days_late": variable(*_PAIR, "fvl_numero_dias_atraso"),
    "value_class": variable(*_AMOUNTS, AMOUNT),
    "pct_paid": variable(*_AMOUNTS, "fvl_pct_fatura_pgto"),
    "pct_paid_as_written": variable(*_AMOUNTS, "fvl_pct_fatura_pgto", mode=AS_WRITTEN),
    "window_flags": flags,
    "stage": stage(INTENDED),
    "stage_as_written": stage(AS_WRITTEN),
    "stage_by_payment": stage_by_payment,
    "book": book(BookSpec()),
    "book_documented": book(BookSpec().documented()),
    "book_up_to_reference": book(BookSpec(include_after_ref=False)),
    "book_from_text": book_from_text(INTENDED),
    "book_as_written": book_from_text(AS_WRITTEN),
    "book_refreshed": book_refreshed,
    "books_of_a_year": books_of_a_year,
    "book_long": book_long,
    "book_catalog": book_catalog,
}
