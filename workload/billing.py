"""Billing tables derived from `orders` and `lineitem`.

Only expressions that mean the same in Spark and DuckDB are used; the SQL twin
of this module is `workload.oracle`.

* An order is an invoice: due 10 days after issue, minimum 15 % of the total.
  Orders of status F were issued again in a second load, 10.00 dearer. Some
  orders lack a customer.
* A line item is a payment of its order, up to 10 days before or after the due
  date, of one of five amounts. Its return flag tells which load brought it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billbook.config import Zones
from billbook.session import scratch_dir
from billbook.sinks.lake import write_raw

REF_DATE = "2000-02-01"
RUN_TS = "20000204220000"
LOADS = ("20000201080000", "20000202080000", "20000203080000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customer() -> Column:
    nameless = (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P")
    return F.when(~nameless, F.col("o_custkey"))


def _minimum() -> Column:
    return F.col("valor_fatura") * F.lit("0.15").cast("decimal(3,2)")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    issued = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id_fatura"),
        _customer().alias("id_cliente"),
        "o_orderstatus",
        "o_orderpriority",
        issued.alias("data_emissao"),
        F.date_add(issued, 10).alias("data_vencimento"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("valor_fatura"),
    )


def _month(day: str) -> Column:
    return F.date_format(day, "yyyyMM").cast("int").alias("ref")


def _issued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the raw invoices follow from, one row an order."""
    again = (F.col("o_orderstatus") == "F").alias("again")
    return _orders(spark, sf_dir).select(
        "id_fatura", "id_cliente", "data_emissao", "valor_fatura", again, _month("data_emissao")
    )


def _as_invoices(issued: DataFrame) -> DataFrame:
    copies = F.when(F.col("again"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    dearer = F.col("valor_fatura") + F.col("load") * F.lit("10.00").cast("decimal(4,2)")
    return issued.withColumn("load", F.explode(copies)).select(
        "id_fatura",
        "id_cliente",
        F.element_at(F.array(*map(F.lit, LOADS)), F.col("load") + 1).alias("dt_proc"),
        "data_emissao",
        F.date_add("data_emissao", 10).alias("data_vencimento"),
        dearer.cast("decimal(15,2)").alias("valor_fatura"),
        _minimum().cast("decimal(15,2)").alias("valor_pagamento_minimo"),
        "ref",
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw invoices: the first load, and status F again in the second."""
    return _as_invoices(_issued(spark, sf_dir))


def _paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the raw payments follow from, one row a line item."""
    load = F.when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "A", 2).otherwise(3)
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id_fatura"), "l_linenumber", load.alias("load")
    )
    key, line = F.col("id_fatura"), F.col("l_linenumber")
    offset = ((key + 3 * line) % 21 - 10).cast("int")
    orders = _orders(spark, sf_dir).select("id_fatura", "id_cliente", "data_vencimento", "valor_fatura")
    paid_on = F.date_add("data_vencimento", offset).alias("data_pagamento")
    return (
        lines.join(orders, "id_fatura")
        .select("id_fatura", "id_cliente", "l_linenumber", "load", paid_on, "valor_fatura")
        .withColumn("ref", _month("data_pagamento"))
    )


def _as_payments(paid: DataFrame) -> DataFrame:
    key, line = F.col("id_fatura"), F.col("l_linenumber")
    total = F.col("valor_fatura")
    minimum = _minimum().cast("decimal(15,2)")

    def share(of: Column, text: str) -> Column:
        return (of * F.lit(text).cast("decimal(3,2)")).cast("decimal(15,2)")

    kind = (key + line) % 5
    amount = (
        F.when(kind == 0, minimum)
        .when(kind == 1, total)
        .when(kind == 2, share(minimum, "0.50"))
        .when(kind == 3, share(total, "0.50"))
        .otherwise(share(total, "1.10"))
    )
    return paid.select(
        F.concat(key.cast("string"), line.cast("string")).alias("id_pagamento"),
        "id_fatura",
        "id_cliente",
        F.element_at(F.array(*map(F.lit, LOADS)), F.col("load")).alias("dt_proc"),
        "data_pagamento",
        amount.alias("valor_pagamento"),
        "ref",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payments, three loads."""
    return _as_payments(_paid(spark, sf_dir))


def _iso(day: str) -> Column:
    return F.date_format(day, "yyyy-MM-dd").alias(day)


def invoice_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices as a database extract would give them, with some malformed values."""
    orders = _orders(spark, sf_dir)
    no_hyphen = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    no_due = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    key = F.col("id_fatura").cast("string")
    return orders.select(
        F.when(no_hyphen, F.concat(F.lit("F"), key)).otherwise(F.concat(F.lit("F-"), key)).alias("id_fatura"),
        F.col("id_cliente").cast("string").alias("id_cliente"),
        _iso("data_emissao"),
        F.when(no_due, "sem data").otherwise(_iso("data_vencimento")).alias("data_vencimento"),
        F.col("valor_fatura").cast("string").alias("valor_fatura"),
        _minimum().cast("decimal(19,4)").cast("string").alias("valor_pagamento_minimo"),
    )


def payment_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = payments(spark, sf_dir)
    return paid.select(
        F.concat_ws("-", F.lit("P"), "id_pagamento").alias("id_pagamento"),
        F.concat(F.lit("F-"), F.col("id_fatura").cast("string")).alias("id_fatura"),
        F.col("id_cliente").cast("string").alias("id_cliente"),
        _iso("data_pagamento"),
        F.col("valor_pagamento").cast("string").alias("valor_pagamento"),
    )


def malformed_payment_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment text of which every fifth line item has no readable amount and every seventh no date."""
    text = payment_text(spark, sf_dir)
    line = F.substring_index("id_pagamento", "-", -1).cast("bigint")
    return text.select(
        "id_pagamento", "id_fatura", "id_cliente",
        F.when(line % 7 == 0, "10/05/2000").otherwise(F.col("data_pagamento")).alias("data_pagamento"),
        F.when(line % 5 == 0, "x").otherwise(F.col("valor_pagamento")).alias("valor_pagamento"),
    )


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an invoice extract as one column named as the header.

    Of eleven orders one each has decimal commas, ends after three fields, has a quote that is not closed, has one before the last
    value, and is quoted throughout, as is allowed.
    """
    text = invoice_text(spark, sf_dir)
    values = [F.coalesce(c, F.lit("")) for c in text.columns]
    comma = [F.translate(v, ".", ",") for v in values]
    quote = F.lit('"')
    kind = F.regexp_extract("id_fatura", r"(\d+)$", 1).cast("bigint") % 11
    line = (
        F.when(kind == 0, F.concat_ws(",", *values[:4], *comma[4:]))
        .when(kind == 1, F.concat_ws(",", *values[:3]))
        .when(kind == 2, F.concat_ws(",", *values[:2], F.concat(quote, values[2]), *values[3:]))
        .when(kind == 3, F.concat_ws(",", *values[:5], F.concat(quote, values[5])))
        .when(kind == 4, F.concat_ws(",", *[F.concat(quote, v, quote) for v in values]))
        .otherwise(F.concat_ws(",", *values))
    )
    return text.select(line.alias(",".join(text.columns)))


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines as they are, under a header."""
    lines.write.options(header="true", quote="", sep="\u0001", escape="\u0001").csv(path)


_lakes: dict[tuple[str, str], Zones] = {}
_done: set[tuple[str, str, str]] = set()


def once(spark: SparkSession, sf_dir: str, name: str, action: Callable[[], None]) -> None:
    """Run `action` the first time this session asks for `name`."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _done:
        action()
        _done.add(key)


_RAW = {"faturas": (_issued, _as_invoices), "pagamentos": (_paid, _as_payments)}


def lake(spark: SparkSession, sf_dir: str, names: Sequence[str] = tuple(_RAW)) -> Zones:
    """A lake whose raw zone holds all of the tables asked for; each is written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    zones = _lakes.setdefault(key, Zones(scratch_dir(spark, "lake")))
    for name in names:
        rows, derive = _RAW[name]
        once(
            spark, sf_dir, f"raw {name}",
            lambda: write_raw(rows(spark, sf_dir), zones.raw(name), "overwrite", derive),  # noqa: B023
        )
    return zones
