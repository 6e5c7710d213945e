from collections import Counter

from billing_rows import LOAD_1, LOAD_2, frames, invoice, payment

from billbook.config import AS_WRITTEN
from billbook.operators.dedup import dedup_latest, latest_key


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_later_load_wins_and_later_month_before_it(spark):
    inv, _ = frames(
        spark,
        [invoice(1), invoice(1, load=LOAD_2, total="90.00"),
         invoice(2, load=LOAD_2), invoice(2, ref=202402, total="80.00")],
        [payment(1, "2024-01-02", "1.00")],
    )
    kept = {(r["id_fatura"], float(r["valor_fatura"])) for r in dedup_latest(inv).collect()}
    assert kept == {(1, 90.0), (2, 80.0)}


def test_ties_stay_and_null_keys_go(spark):
    _, pay = frames(
        spark,
        [invoice(1)],
        [payment(1, "2024-01-02", "1.00", number="a"), payment(1, "2024-01-03", "2.00", number="b"),
         payment(1, "2023-12-03", "3.00", number="c", ref=202312),
         payment(2, "2024-01-03", "4.00", cliente=None)],
    )
    assert sorted(r["id_pagamento"] for r in dedup_latest(pay).collect()) == ["a", "b"]


def test_idempotent(spark):
    inv, _ = frames(
        spark, [invoice(n % 5, load=(LOAD_1, LOAD_2)[n % 2], total=f"{n}.00") for n in range(40)],
        [payment(1, "2024-01-02", "1.00")],
    )
    once = dedup_latest(inv)
    assert _rows(dedup_latest(once)) == _rows(once)


def test_as_written_equals_its_join(spark):
    """All versions stay; each group with a NULL key becomes one all-NULL row."""
    inv, _ = frames(
        spark,
        [invoice(1), invoice(1, load=LOAD_2), invoice(2, cliente=None), invoice(2, cliente=None, load=LOAD_2),
         invoice(None, cliente=3), invoice(None, cliente=None), invoice(4)],
        [payment(1, "2024-01-02", "1.00")],
    )
    inv.createOrReplaceTempView("versions")
    literal = spark.sql("""
        select b.* from (select id_cliente, id_fatura from versions group by 1, 2) a
        left join versions b on a.id_cliente = b.id_cliente and a.id_fatura = b.id_fatura
    """)
    found = _rows(dedup_latest(inv, mode=AS_WRITTEN))
    assert found == _rows(literal)
    assert found[(None,) * 8] == 3


def test_latest_key(spark):
    inv, _ = frames(
        spark, [invoice(1), invoice(1, load=LOAD_2), invoice(1, ref=202312, load=LOAD_2), invoice(2)],
        [payment(1, "2024-01-02", "1.00")],
    )
    found = {r["id_fatura"]: r["max_dedup_key"] for r in latest_key(inv).collect()}
    assert found == {1: "202401" + LOAD_2, 2: "202401" + LOAD_1}
