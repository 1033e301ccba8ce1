from decimal import Decimal

from conftest import rows

from millrace.operators.semi import split_kv
from millrace.plans import semistructured as semi

# A page view and a purchase by one user, a click without typed fields by another.
EVENTS = [
    ("e1", '{"type":"page_view","user":{"id":7,"country":"NZ"},"page":"/help","ts":"2025-03-09T06:30:00Z"}'),
    (
        "e2",
        '{"type":"purchase","user":{"id":7,"country":"NZ"},"order":{"id":"x-77","total":31.25,"items":'
        '[{"sku":"P9","qty":5,"price":4.25},{"sku":"Q3","qty":1,"price":10.0}]},"ts":"2025-03-09T06:41:30Z"}',
    ),
    ("e3", '{"type":"click","user":{"id":15,"country":"CL"},"element":"menu_open","ts":"2025-03-11T22:05:40Z"}'),
]


def raw(spark, events=EVENTS):
    return spark.createDataFrame(
        [(i, None, p) for i, p in events], "event_id string, received_ts timestamp_ntz, payload string"
    )


def test_typed_projection(spark):
    got = {r.event_id: r for r in semi.typed_events(raw(spark)).collect()}
    assert set(got) == {"e1", "e2"}
    assert got["e2"].order_total == Decimal("31.25") and got["e2"].item_count == 2
    assert got["e1"].item_count is None and got["e1"].order_total is None
    assert str(got["e1"].event_ts) == "2025-03-09 06:30:00"


def test_items_are_flattened(spark):
    got = [(r.item_idx, r.sku, r.line_total) for r in semi.json_items(raw(spark)).orderBy("item_idx").collect()]
    assert got == [(0, "P9", Decimal("21.25")), (1, "Q3", Decimal("10.00"))]


def test_profiles_and_keys(spark):
    profiles = {r.user_id: r.profile for r in semi.json_profiles(raw(spark)).collect()}
    assert profiles[7] == (
        '{"user_id":"7","country":"NZ","first_event":"2025-03-09T06:30:00Z",'
        '"last_event":"2025-03-09T06:41:30Z","types":["page_view","purchase"]}'
    )
    keys = {(r.event_id, r.key_name): r.key_value for r in semi.json_keys(raw(spark)).collect()}
    assert keys[("e3", "element")] == "menu_open"
    assert keys[("e3", "user")] == '{"country":"CL","id":15}'


def test_odd_payloads(spark):
    odd = [("bad", '{"type": '), ("null", None), ("jsonnull", '{"type":"purchase","order":{"total":"x","items":[]},"a":null}')]
    df = raw(spark, odd)
    assert {r.event_id: r.is_corrupt for r in semi.json_corrupt(df).collect()} == {"bad": True, "null": True, "jsonnull": False}
    typed = semi.typed_events(df).collect()
    assert [(r.event_id, r.order_total, r.item_count) for r in typed] == [("jsonnull", None, 0)]
    assert semi.json_items(df).count() == 0
    assert ("jsonnull", "a", None) in rows(semi.json_keys(df))


def test_split_kv_edges(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "plain"), (4, "a=b=c,\tk = v\n,x=")], "id int, log string")
    assert rows(split_kv(df, "log", ["id"])) == [(4, "a", "b=c"), (4, "k", "v"), (4, "x", "")]


def test_large_orders_are_split_into_bounded_parts_and_stay_whole(spark):
    import json

    lines = [(1, f"S{i % 40}", i % 3 + 1, "1.00") for i in range(200)]
    lines += [(1, "COPY", 1, "2.00")] * 300  # one item repeated
    lines += [(2, "S1", 1, "1.00"), (2, "S0", 2, "3.00")]
    items = spark.createDataFrame(lines, "order_id int, sku string, quantity int, unit_price string")
    got = semi.order_payloads(items, part_size=50).collect()
    whole = {}
    for r in got:
        part = json.loads(r.payload)
        assert len(part) <= 50
        whole.setdefault(r.order_id, []).extend((e["sku"], int(e["qty"]), e["price"]) for e in part)
    assert {r.order_id: r.line_count for r in got} == {1: 500, 2: 2}
    for order in (1, 2):
        assert sorted(whole[order]) == sorted((s, q, p) for o, s, q, p in lines if o == order)
    assert [r.part_no for r in got if r.order_id == 2] == [0]
