import datetime as dt
import json
from decimal import Decimal

import golden
import pytest
from ordervane.operators import events as ev
from ordervane.operators.rows import with_values
from ordervane.schemas import EVENT_TEXT, MONEY, RAW_ERP_ORDERS
from ordervane.sources.event_streams import event_messages

GOOD = {"customer_id": 123, "product_id": "PROD-456", "quantity": 2, "price": 199.99}


def texts(spark, values):
    return golden.frame(spark, [(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values],
                        "value string")


def validated(spark, *values):
    return ev.validate_order_event(ev.parse_events(texts(spark, values)))


@pytest.mark.parametrize("change, reason", [
    ({}, None),
    ({"product_id": 7}, None),
    ({"quantity": "2"}, None),
    ({"order_id": 5, "order_date": "2024-01-01", "status": "paid", "extra": [1, {"a": 2}]}, None),
    ({"customer_id": None}, "customer_id"),
    ({"product_id": None}, "product_id"),
    ({"quantity": "x"}, "quantity"),
    ({"quantity": 2.7}, "quantity"),
    ({"quantity": 10 ** 12}, "quantity"),
    ({"price": "cheap"}, "price"),
    ({"order_id": "abc"}, "order_id"),
])
def test_validation(spark, change, reason):
    assert validated(spark, {**GOOD, **change}).first().reject_reason == reason


@pytest.mark.parametrize("text", ["not json", '{"customer_id": 1,', "[1, 2]", "7", "", None])
def test_texts_that_are_no_object(spark, text):
    assert validated(spark, text).first().reject_reason == "not a JSON object"


def test_missing_field_is_rejected_with_its_text(spark):
    rows = validated(spark, {"product_id": "p", "quantity": 1, "price": 1.0}, GOOD)
    assert [tuple(r) for r in ev.dead_letters(rows).collect()] == [
        ('{"product_id": "p", "quantity": 1, "price": 1.0}', "customer_id")]
    kept = ev.valid_events(rows).collect()
    assert [(r.customer_id, r.product_id, r.quantity, r.price) for r in kept] == [(123, "PROD-456", 2, 199.99)]


def test_enrichment_defaults(spark):
    orders = golden.frame(
        spark, [(1, "2024-01-01", "paid"), (2, "", None), (3, None, None)],
        "customer_id int, order_date string, status string")
    sent = dt.datetime(2024, 3, 1, 12, 0, 0, 5)
    rows = ev.enrich_order_event(orders, sent).orderBy("customer_id").collect()
    stamp = "2024-03-01T12:00:00.000005"
    assert [(r.order_date, r.status) for r in rows] == [
        ("2024-01-01", "paid"), (stamp, "pending"), (stamp, "pending")]
    assert {(r.timestamp, r.event_type) for r in rows} == {(stamp, "order_event")}


def test_messages_keep_nulls_and_can_be_spread(spark):
    orders = golden.frame(spark, [(1, None)], "customer_id int, status string")
    assert json.loads(event_messages(orders).first().value) == {"customer_id": 1, "status": None}
    assert event_messages(orders, 5).rdd.getNumPartitions() == 5


def test_routes(spark):
    values = [{"event_type": t} for t in ("order_event", "crm_data", "erp_data", "click", None)]
    values += [{"other": 1}, "broken"]
    rows = ev.route_events(ev.parse_events(texts(spark, values))).collect()
    assert [r.route for r in rows] == ["order", "crm", "erp", "events", "events", "events", "dead_letter"]


def landed(spark, *events):
    names = EVENT_TEXT.names
    rows = [tuple(None if e.get(n) is None else str(e[n]) for n in names) for e in events]
    return golden.frame(spark, rows, EVENT_TEXT)


FULL = {**GOOD, "timestamp": "2024-03-01T12:00:00.000005", "order_date": "2024-02-29T08:00:00"}


def test_mapping(spark):
    mapped = ev.map_order_event(landed(spark, {**FULL, "event_id": "e1", "order_id": 9}), "2024-03-02 00:00:00")
    assert [f.dataType for f in mapped.schema.fields[:-2]] == [f.dataType for f in RAW_ERP_ORDERS.fields]
    row = ev.loadable(mapped).first()
    assert tuple(row) == (
        "e1", 123, "PROD-456", 2, Decimal("199.99"), Decimal("399.98"), "completed",
        dt.datetime(2024, 3, 1, 12, 0, 0, 5), dt.datetime(2024, 3, 2))
    by_order_date = ev.map_order_event(landed(spark, FULL), "2024-03-02", order_date_from="order_date").first()
    assert by_order_date.order_date == dt.datetime(2024, 2, 29, 8)


def test_order_key(spark):
    events = landed(spark, {**FULL, "event_id": "e", "order_id": 9}, {**FULL, "order_id": 9}, FULL, FULL,
                    {**FULL, "quantity": 3}, {**FULL, "event_id": " ", "order_id": 9}, {**FULL, "event_id": "9", "order_id": ""},
                    {**FULL, "event_id": "order:9"})
    first = [r.order_id for r in ev.map_order_event(events, "2024-03-02").collect()]
    again = [r.order_id for r in ev.map_order_event(events, "2024-03-03").collect()]
    assert first == again
    assert first[:2] == ["e", "order:9"]
    assert first[2] == first[3] != first[4] and first[2].startswith("hash:") and len(first[2]) == 69
    assert first[5:] == ["order:9", "9", "event:order:9"]


@pytest.mark.parametrize("change, error", [
    ({"price": "1e12"}, "price"),
    ({"quantity": 2_000_000_000, "price": "99999999.99"}, "total_amount"),
    ({"quantity": "two"}, "quantity"),
    ({"customer_id": "x"}, "customer_id"),
    ({"timestamp": "yesterday-ish"}, "timestamp"),
    ({"customer_id": None}, None),
])
def test_rows_that_do_not_fit_are_set_apart(spark, change, error):
    mapped = ev.map_order_event(landed(spark, {**FULL, **change}, FULL), "2024-03-02")
    assert mapped.first().load_error == error
    assert ev.loadable(mapped).count() + ev.quarantined(mapped).count() == 2
    assert ev.quarantined(mapped).count() == (error is not None)


def test_total_rounds_like_doubles(spark):
    row = ev.map_order_event(landed(spark, {**FULL, "quantity": 3, "price": "1.115"}), "2024-03-02").first()
    assert row.total_amount == Decimal("3.34")  # 3 * 1.115 is 3.3449999... as a double
    assert row.unit_price == Decimal("1.12")


@pytest.mark.parametrize("limit, first, count", [(10, 140, 10), (0, 50, 100), (-3, 50, 100), (500, 50, 100)])
def test_recent_events(spark, limit, first, count):
    events = spark.range(150).selectExpr("lpad(id, 5, '0') AS timestamp", "id AS event_id")
    seen = [r.event_id for r in ev.recent_events(events.repartition(5), limit).collect()]
    assert seen == list(range(first, first + count))


def test_with_values(spark):
    df = golden.frame(spark, [(1, None), (None, 2), (3, 4)], "a int, b int")
    assert [tuple(r) for r in with_values(df, "a", "b").collect()] == [(3, 4)]
    assert MONEY.precision == 10
