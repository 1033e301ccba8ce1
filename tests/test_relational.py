import random

from conftest import rows
from pyspark.sql import functions as F

from millrace.plans import governance as gov
from millrace.plans import relational as rel
from millrace.sources.retail import AS_OF_ORDERS


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_near_names_agree_with_comparing_all_pairs(spark):
    rng = random.Random(9)
    people = [(i, rng.choice("XY"), "Ann", "".join(rng.choice("abc") for _ in range(rng.randrange(0, 6)))) for i in range(90)]
    people += [(90 + i, "X", "Ann", "abcab") for i in range(40)]  # a third are copies of one name
    df = spark.createDataFrame(people, "customer_id int, country string, first_name string, last_name string")
    reps = {}
    for i, c, f, n in people:
        reps[(c, f, n)] = min(i, reps.get((c, f, n), i))
    want = [(i, reps[(c, f, n)], 0) for i, c, f, n in people if reps[(c, f, n)] != i]
    names = sorted((rep, c, n) for (c, _, n), rep in reps.items())
    for x, (a, ca, na) in enumerate(names):
        for b, cb, nb in names[x + 1 :]:
            if ca == cb and len(na) == len(nb) and levenshtein(na, nb) <= 2:
                want.append((a, b, levenshtein(na, nb)))
    assert rows(rel.name_distance(df)) == sorted(want, key=repr)


def test_approximations_are_close(retail):
    exact = {
        r.channel: r
        for r in retail.orders.groupBy("channel")
        .agg(F.count_distinct("customer_id").alias("n"), F.median("total_amount").alias("m"), F.expr("percentile(total_amount, 0.95)").alias("p"))
        .collect()
    }
    for r in rel.approx_channel(retail.orders).collect():
        e = exact[r.channel]
        assert abs(r.approx_customers - e.n) <= 0.05 * e.n
        assert abs(float(r.approx_median) - float(e.m)) <= 0.05 * float(e.m)
        assert abs(float(r.approx_p95) - float(e.p)) <= 0.05 * float(e.p)


def test_sample_is_repeatable_and_near_its_rate(retail):
    base = retail.orders.where(F.col("order_ts") >= rel.since(AS_OF_ORDERS, "3 months")).count()
    picked = rel.sample_orders(retail.orders, AS_OF_ORDERS, 0.5)
    assert rows(picked) == rows(rel.sample_orders(retail.orders, AS_OF_ORDERS, 0.5))
    assert 0.2 * base < picked.count() < 0.8 * base


def test_pivot_and_unpivot_undo_each_other(spark, retail):
    wide = retail.daily_channel_metrics
    long = wide.unpivot(["day"], [c for c in wide.columns if c != "day"], "channel", "spend").where("spend is not null")
    back = long.groupBy("day").pivot("channel", [c for c in wide.columns if c != "day"]).agg(F.first("spend"))
    blank = wide.where("coalesce(web_spend, mobile_spend, retail_spend, partner_spend) is not null")
    assert rows(back) == rows(blank)


def test_roles_see_what_they_may(retail):
    seen = {role: gov.secure_customers(retail.customers, retail.role_country_map, role) for role in ("ACCOUNTADMIN", "PII_ADMIN", "R0", "NOBODY")}
    total = retail.customers.count()
    assert seen["ACCOUNTADMIN"].count() == total
    assert seen["ACCOUNTADMIN"].where("email like '%@%' and email not like 'c***@%'").isEmpty()
    assert 0 < seen["PII_ADMIN"].count() < total and not seen["PII_ADMIN"].where("email like 'customer0%'").isEmpty()
    assert seen["NOBODY"].isEmpty()


def test_filters_and_columns_reach_the_scan(retail):
    plan = rel.topn_recent(retail.orders, AS_OF_ORDERS)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "o_orderpriority" not in plan
