"""Salted plans must give exactly what the plain ones give."""

from collections import Counter

import pytest
from billing_rows import LOAD_1, LOAD_2, REF_DATE, frames, invoice, payment, random_stage
from pyspark.sql import functions as F

from billbook.config import AS_WRITTEN
from billbook.operators.dedup import dedup_latest
from billbook.operators.skew import SALT, find_hot_keys, plan_cells, salted
from billbook.plans.book import feature_book, feature_book_direct
from billbook.plans.spec import BookSpec
from billbook.plans.stage import latest_joined, latest_versions


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def _hot(df, rows_per_task=20):
    return {(r["id_cliente"], r["id_fatura"]): r["rows"] for r in find_hot_keys(df, rows_per_task=rows_per_task).collect()}


def _tables(spark, hot_invoice=False, hot_payment=False, load_of_hot=LOAD_1):
    invoices = [invoice(n, cliente=n % 7, total=f"{n}.00") for n in range(1, 60)]
    payments = [payment(n, "2024-01-05", f"{n}.00", cliente=n % 7, number=f"p{n}") for n in range(1, 50)]
    if hot_invoice:
        # copies of one version, and older ones that must go
        invoices += [invoice(1, total="1.00")] * 40
        invoices += [invoice(1, total="0.50", ref=202312)] * 40
        invoices += [invoice(55, cliente=55 % 7, load=LOAD_2, total="2.00")] * 40
    if hot_payment:
        payments += [
            payment(2, "2024-01-06", "0.25", cliente=2, number=f"h{n % 3}", load=load_of_hot)
            for n in range(50)
        ]
        payments += [payment(2, "2023-12-06", "0.75", cliente=2, ref=202312)] * 30
        # hot, and without an invoice
        payments += [payment(999, "2024-01-06", "0.25", cliente=3)] * 50
    return frames(spark, invoices, payments)


@pytest.mark.parametrize("hot_invoice, hot_payment", [(True, False), (False, True), (True, True)])
@pytest.mark.parametrize("load_of_hot", [LOAD_1, LOAD_2])
def test_salted_join(spark, hot_invoice, hot_payment, load_of_hot):
    inv, pay = _tables(spark, hot_invoice, hot_payment, load_of_hot)
    found_inv, found_pay = set(_hot(inv)), set(_hot(pay))
    assert found_inv == ({(1, 1), (6, 55)} if hot_invoice else set())
    assert found_pay == ({(2, 2), (3, 999)} if hot_payment else set())
    spread = latest_joined(inv, pay, rows_per_task=20)
    assert _rows(spread) == _rows(latest_joined(inv, pay, rows_per_task=None))


def test_salted_dedup_of_one_table(spark):
    inv, pay = _tables(spark, hot_invoice=True, hot_payment=True, load_of_hot=LOAD_2)
    for df in (inv, pay):
        salted_rows = latest_versions(df, rows_per_task=20)
        assert salted_rows.columns == df.columns
        assert _rows(salted_rows) == _rows(dedup_latest(df))
    assert _rows(latest_versions(inv, AS_WRITTEN, 20)) == _rows(dedup_latest(inv, mode=AS_WRITTEN))


def test_key_hot_on_both_sides(spark):
    inv, pay = frames(
        spark,
        [invoice(1)] * 25 + [invoice(1, total="9.00", ref=202312)] * 25 + [invoice(2)],
        [payment(1, "2024-01-05", "5.00", number=f"p{n}") for n in range(30)],
    )
    spread = latest_joined(inv, pay, rows_per_task=20)
    assert _rows(spread) == _rows(latest_joined(inv, pay, rows_per_task=None))
    assert spread.count() == 25 * 30 + 1


def test_salting_spreads_a_hot_key(spark):
    _, pay = _tables(spark, hot_payment=True)
    cells = plan_cells(find_hot_keys(pay, rows_per_task=20), None, ("id_cliente", "id_fatura"), 20)
    rows = salted(pay.repartition(4), cells, "left").where("id_fatura = 2")
    assert rows.select(SALT).distinct().count() >= 2
    assert rows.where("ref = 202312").count() == 0


def test_exact_counts_and_null_keys(spark):
    _, pay = frames(
        spark, [invoice(1)],
        [payment(1, "2024-01-05", "5.00")] * 30 + [payment(2, "2024-01-05", "5.00", cliente=None)] * 90,
    )
    assert _hot(pay) == {(1, 1): 30}


def test_no_rows(spark):
    inv, _ = frames(spark, [invoice(1)], [payment(1, "2024-01-05", "5.00")])
    assert find_hot_keys(inv.where("id_fatura < 0")).isEmpty()


def test_every_hot_key_is_found(spark):
    """3,000 keys of 40 rows, and one of 3,000 rows among two million."""
    columns = ["cast(1 as bigint) as id_cliente", "'20240201080000' as dt_proc", "202401 as ref"]
    many = spark.range(120_000).selectExpr("id % 3000 as id_fatura", *columns)
    assert find_hot_keys(many, rows_per_task=20).count() == 3000
    rare = spark.range(2_000_000).selectExpr("if(id < 3000, -1, id) as id_fatura", *columns)
    assert _hot(rare, 1000) == {(1, -1): 3000}


def _shuffled(df):
    """Records that each shuffle of an executed frame has written."""
    df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = [node.metrics().apply("shuffleRecordsWritten").value()] if name == "ShuffleExchangeExec" else []
        children = node.children()
        return own + [n for i in range(children.size()) for n in walk(children.apply(i))]

    return walk(df._jdf.queryExecution().executedPlan())


def test_rare_keys_are_not_shuffled(spark):
    columns = ["cast(1 as bigint) as id_cliente", "'20240201080000' as dt_proc", "202401 as ref"]
    rare = spark.range(0, 2_000_000, 1, 16).selectExpr("if(id % 100 = 0, -1, id) as id_fatura", *columns)
    found = find_hot_keys(rare, rows_per_task=1000)
    records = _shuffled(found)
    assert [tuple(r)[:3] for r in found.collect()] == [(1, -1, 20_000)]
    assert len(records) >= 2 and max(records) <= 16


@pytest.mark.parametrize("rows_per_task", [300, 1000, 5000])
def test_candidates_where_sketches_forget(spark, monkeypatch, rows_per_task):
    """Keys a little above the limit, spread over tasks of very different sizes among keys that are rare."""
    from billbook.operators import skew

    hot = rows_per_task + 1
    rows = spark.range(0, 400_000, 1, 11).selectExpr("case when id < 200000 then id else id % 17 + 500000 end as k")
    spread = spark.range(0, 5 * hot, 1, 7).selectExpr("-(id % 5) - 1 as k")
    df = rows.unionByName(spread).unionByName(spark.range(0, 90_000, 1, 1).selectExpr("id + 1000000 as k"))
    total = df.count()
    found = {r.k for r in skew.candidates(df, "k", total, rows_per_task).collect()}
    counts = {r.k: r["count"] for r in df.groupBy("k").count().where("count > 50").collect()}
    assert {k for k, n in counts.items() if n > rows_per_task} <= found
    assert len(found) <= 2 * total / rows_per_task


def test_small_tables_write_nothing_to_find_hot_keys(spark, monkeypatch):
    from billbook.operators import skew

    inv, pay = _tables(spark, hot_payment=True)
    monkeypatch.setattr(skew, "plan_cells", lambda *_: pytest.fail("searched"))
    assert latest_joined(inv, pay, rows_per_task=1000).count() > 0
    assert latest_versions(pay, rows_per_task=1000).count() > 0


def test_a_key_hot_on_both_sides_becomes_a_grid(spark):
    inv, pay = frames(
        spark, [invoice(1, total=f"{n}.00") for n in range(100)],
        [payment(1, "2024-01-05", "5.00", number=f"p{n}") for n in range(100)],
    )
    keys = ("id_cliente", "id_fatura")
    cells = plan_cells(find_hot_keys(inv, rows_per_task=20), find_hot_keys(pay, rows_per_task=20), keys, 20)
    left = salted(inv.repartition(4), cells, "left").groupBy(SALT).count().collect()
    right = salted(pay.repartition(4), cells, "right").groupBy(SALT).count().collect()
    assert len(left) == len(right) == 25
    assert max(r["count"] for r in left + right) < 60
    spread = latest_joined(inv, pay, rows_per_task=20)
    assert _rows(spread) == _rows(latest_joined(inv, pay, rows_per_task=None))


@pytest.mark.parametrize("rows_per_task", [20, None])
def test_payments_kept_apart_by_their_own_key(spark, rows_per_task):
    inv, pay = _tables(spark, hot_invoice=True, hot_payment=True)
    keys = ("id_cliente", "id_fatura", "id_pagamento")
    found = latest_joined(inv, pay, rows_per_task=rows_per_task, payment_keys=keys)
    paid = dedup_latest(pay, keys).select("id_cliente", "id_fatura", "data_pagamento", "valor_pagamento")
    expected = dedup_latest(inv).join(paid, ["id_cliente", "id_fatura"], "left").select(*found.columns)
    assert _rows(found) == _rows(expected)
    with pytest.raises(ValueError):
        latest_joined(inv, pay, payment_keys=("id_pagamento",))


@pytest.mark.parametrize("rows_per_task", [20, 1000, None])
def test_as_written_equals_its_sql(spark, rows_per_task):
    """All versions joined, with hot keys on either side and many invoices without a customer."""
    inv, pay = _tables(spark, hot_invoice=True, hot_payment=True)
    nameless, unmatched = frames(
        spark, [invoice(n, cliente=None) for n in range(30)],
        [payment(3, "2024-01-06", "5.00", cliente=None)],
    )
    inv, pay = inv.unionByName(nameless), pay.unionByName(unmatched)
    inv.createOrReplaceTempView("inv_all")
    pay.createOrReplaceTempView("pay_all")
    literal = spark.sql("""
        with i as (
            select b.* from (select distinct id_cliente, id_fatura from inv_all) a
            left join inv_all b on a.id_cliente = b.id_cliente and a.id_fatura = b.id_fatura
        ), p as (
            select b.* from (select distinct id_cliente, id_fatura from pay_all) a
            left join pay_all b on a.id_cliente = b.id_cliente and a.id_fatura = b.id_fatura
        )
        select i.id_fatura, i.id_cliente, i.data_emissao, i.data_vencimento, i.valor_fatura,
               i.valor_pagamento_minimo, p.data_pagamento, p.valor_pagamento
        from i left join p on i.id_fatura = p.id_fatura and i.id_cliente = p.id_cliente
    """)
    rows = _rows(latest_joined(inv, pay, AS_WRITTEN, rows_per_task))
    assert rows == _rows(literal)
    assert rows[(None,) * 8] == 30


def test_book_of_large_customers(spark):
    """A third of the rows on one customer, and many on the NULL customer."""
    stage = random_stage(spark, rows=400).withColumn(
        "id_cliente", F.when(F.col("fvl_numero_dias_atraso") % 3 == 0, 5).otherwise(F.col("id_cliente"))
    )
    spec = BookSpec()

    def near(df):
        return {
            r["id_cliente"]: tuple(round(float(v), 6) if v is not None else None for v in tuple(r)[3:])
            for r in df.collect()
        }

    assert near(feature_book(stage, spec, REF_DATE)) == near(feature_book_direct(stage, spec, REF_DATE))
