"""Gold tables against nested loops over random small batches with repeated and NULL keys."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from smeltery.plans.layers import to_gold
from tests.conftest import rows_of, table_of

DAY = "2025-02-20"
key = st.one_of(st.none(), st.integers(1, 3))
amount = st.sampled_from([None, 1.5, 2.25])
status = st.sampled_from([None, "SHIPPED", "CANCELLED"])
rows = {
    "customers": st.lists(st.tuples(key, *[st.just("x")] * 5), max_size=5),
    "products": st.lists(st.tuples(key, st.sampled_from(["a", "b"]), st.just("c"), st.just(1.0)), max_size=4),
    "orders": st.lists(st.tuples(key, st.just(DAY), key, amount, status), max_size=6),
    "order_items": st.lists(st.tuples(st.just(1), key, key, st.integers(1, 3), st.just(0.1)), max_size=6),
}


def same(a, b):
    return a is not None and a == b


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(batch=st.fixed_dictionaries(rows))
def test_gold_rows(spark, batch):
    gold = to_gold({name: table_of(spark, name, lines) for name, lines in batch.items()})

    valid = [o for o in batch["orders"] for c in batch["customers"] if same(o[2], c[0])]
    items = [i for i in batch["order_items"] for o in valid if same(i[1], o[0])]
    lines = [(i, o) for i in items for o in valid if same(i[1], o[0])]
    is_active = lambda o: o[4] is not None and o[4] != "CANCELLED" and o[3] is not None

    fact = [
        (o[0], o[2], i[2], p[1], i[3], i[3] * i[4], o[3])
        for i, o in lines for p in batch["products"] if same(i[2], p[0])
    ]
    picked = gold["fact_sales"].select(
        "order_id", "customer_id", "product_id", "product_name", "quantity", "line_total", "total_amount"
    )
    assert rows_of(picked) == sorted(fact, key=repr)
    assert rows_of(gold["orders"].drop("order_date")) == sorted(
        ((o[0], o[2], o[3], o[4]) for o in valid if is_active(o)), key=repr
    )
    assert rows_of(gold["order_items"].drop("order_date")) == sorted(
        ((i[1], i[2], i[3], i[4], o[2], o[3], o[4]) for i, o in lines if is_active(o)), key=repr
    )
