"""The customer 360 after each batch equals the one rebuilt from everything that was seen."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from lamella.plans import commerce
from lamella.plans.customer_store import CustomerStore

CUSTOMERS = ("customer_id string, email string, first_name string, last_name string, city string, state string, "
             "signup_date date, is_active boolean")
ORDERS = "order_id string, customer_id string, order_date date, status string, total_amount decimal(18,2), payment_method string"


def _person(i, city="x"):
    return (f"C{i:03d}", f"u{i}@m", "a", "b", city, "NY", dt.date(2023, 1, 1 + i % 28), i % 2 == 0)


def _order(o, c, rnd):
    return (f"O{o:04d}", f"C{c:03d}", dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 200)),
            rnd.choice(commerce.ORDER_STATUSES), Decimal(rnd.randint(0, 90000)) / 100, "card")


def _rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())


def _batches():
    rnd = random.Random(3)
    first = [_order(o, 7 if o % 3 == 0 else rnd.randint(0, 39), rnd) for o in range(300)]  # one customer has a third
    moved = [(o, "C041", day, status, amount, pay) for o, _, day, status, amount, pay in first[:20]]
    refunded = [(o, c, day, "refunded", amount, pay) for o, c, day, _, amount, pay in first if c == "C005"]
    newer = [_order(o, 50, rnd) for o in range(300, 305)]  # orders of a customer that comes with the next batch
    back = [(o, c, day, "completed", amount, pay) for o, c, day, _, amount, pay in refunded[:1]]
    return [
        ([_person(i) for i in range(45)], first, "2024-08-01"),
        ([_person(3, "moved"), _person(60)], list({r[0]: r for r in refunded + moved + newer}.values()), "2024-08-01"),
        ([_person(50)], back, "2024-08-01"),
        ([], [_order(400, 8, rnd)], "2024-09-15"),
    ]


@pytest.mark.parametrize("months", [None, 3])
def test_every_batch_equals_the_full_rebuild(spark, tmp_path, months):
    store = CustomerStore(spark, str(tmp_path / "s"), window_months=months)
    people, orders, written = {}, {}, []
    for n, (some, changed, day) in enumerate(_batches()):
        people.update({p[0]: p for p in some})
        orders.update({o[0]: o for o in changed})
        batch = spark.createDataFrame(some, CUSTOMERS), spark.createDataFrame(changed, ORDERS)
        written.append(store.add(*batch, f"b{n}", day))
        whole = commerce.customer_360(
            spark.createDataFrame(list(people.values()), CUSTOMERS), spark.createDataFrame(list(orders.values()), ORDERS), day, months)
        assert _rows(store.table()) == _rows(whole), f"batch {n}"
        if n == 1:
            assert store.add(*batch, "b1", day) == 0, "a batch counts once"
        if n == 2:
            store.compact()
            assert _rows(store.table()) == _rows(whole), "after compaction"
    assert written[0] == 45 and written[3] == 47, "everyone at first and with a new reference date"
    assert written[2] < 47, "only rows that can differ"


def test_a_lost_batch_is_repeated(spark, tmp_path, monkeypatch):
    store = CustomerStore(spark, str(tmp_path / "s"))
    (people, orders, day), (more, changed, _) = _batches()[:2]
    store.add(spark.createDataFrame(people, CUSTOMERS), spark.createDataFrame(orders, ORDERS), "b0", day)
    before, commit = _rows(store.table()), CustomerStore._commit

    def losing(self, table, *rest):
        if table == "batches":
            raise OSError("lost")
        commit(self, table, *rest)

    batch = spark.createDataFrame(more, CUSTOMERS), spark.createDataFrame(changed, ORDERS)
    monkeypatch.setattr(CustomerStore, "_commit", losing)
    with pytest.raises(OSError):
        store.add(*batch, "b1", day)
    assert _rows(store.table()) == before, "an unfinished batch is not seen"
    monkeypatch.undo()
    store.add(*batch, "b1", day)
    whole = commerce.customer_360(
        spark.createDataFrame(list({p[0]: p for p in people + more}.values()), CUSTOMERS),
        spark.createDataFrame(list({o[0]: o for o in orders + changed}.values()), ORDERS), day)
    assert _rows(store.table()) == _rows(whole)


def test_few_customers_and_empty_batches(spark, tmp_path):
    store = CustomerStore(spark, str(tmp_path / "s"))
    none, no_orders = spark.createDataFrame([], CUSTOMERS), spark.createDataFrame([], ORDERS)
    store.add(none, no_orders, "empty", "2024-08-01")
    assert store.table().count() == 0
    rnd = random.Random(1)
    one = [("O1", "C001", dt.date(2024, 1, 1), "completed", Decimal(5), "card")]
    store.add(spark.createDataFrame([_person(1), _person(2)], CUSTOMERS), spark.createDataFrame(one, ORDERS), "few", "2024-08-01")
    assert {r.customer_id: r.rfm_segment for r in store.table().collect()} == {"C001": "Not Scored", "C002": "No Orders"}
    enough = [_order(o, o, rnd)[:3] + ("completed", Decimal(5), "card") for o in range(3, 9)]
    store.add(spark.createDataFrame([_person(i) for i in range(3, 9)], CUSTOMERS), spark.createDataFrame(enough, ORDERS), "more", "2024-08-01")
    assert {r.rfm_segment for r in store.table().where("total_orders > 0").collect()}.isdisjoint({"Not Scored", "No Orders"})
