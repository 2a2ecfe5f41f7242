from __future__ import annotations

import datetime as dt
import re

from conftest import rows
from pyspark.sql import functions as F

from tillroll.functions import places
from tillroll.operators import features as ft
from tillroll.plans.member_features import member_features
from tillroll.registry import views
from tillroll.sources.tables import SCHEMAS

D = dt.date
START, END = D(2023, 7, 17), D(2023, 7, 23)


def lines(spark, data):
    return spark.createDataFrame(data, SCHEMAS["pos_line"])


def line(mid="m01", pma="10", rec="r1", day=START, time="080000", store="1", job="23", units=1, sales=10.0):
    return (mid, pma, rec, day, time, store, job, units, sales)


def test_member_profile_hides_placeholder_birthdays(spark):
    data = [
        ("m01", D(1900, 1, 1), "台北", "1"),
        ("m02", D(1980, 10, 10), "x", "0"),
        ("m03", D(2019, 1, 1), "x", "0"),
        ("m04", D(2000, 12, 31), "臺中", "0"),
        ("m05", D(1923, 1, 2), "x", "0"),
        ("m06", None, "x", "0"),
        ("12", D(1990, 1, 1), "x", "0"),
        ("m04", D(2000, 12, 31), "臺中", "0"),
    ]
    members = spark.createDataFrame(data, SCHEMAS["member"])
    got = rows(ft.member_profile(members, D(2023, 1, 1)))
    assert [(m, a) for m, a, *_ in got] == [
        ("m01", None), ("m02", None), ("m03", None), ("m04", 23), ("m05", None), ("m06", None),
    ]
    assert got[0][2] == "臺北"


def test_scope_keeps_window_job_and_members(spark):
    data = [
        line(rec="in"),
        line(rec="early", day=START - dt.timedelta(1)),
        line(rec="last", day=END),
        line(rec="late", day=END + dt.timedelta(1)),
        line(rec="job", job="24"),
        line(rec="out", pma="22"),
        line(rec="stranger", mid="zzz"),
    ]
    members = spark.createDataFrame([("m01",), ("m01",)], "mid string")
    got = ft.lines_in_scope(lines(spark, data), START, END)
    assert sorted(r["rec_no"] for r in got.collect()) == ["in", "last", "stranger"]
    value = ft.of_known_members(ft.category_value(got), members)
    assert [(r["mid"], r["qty"]) for r in value.collect()] == [("m01", 2)]


def test_category_value_rounds_and_survives_zero_units(spark):
    data = [line(units=2, sales=100.01), line(pma="11", units=1, sales=3.0), line(mid="m02", units=0, sales=5.0)]
    got = {(r["mid"], r["pma_no_fin"]): r for r in ft.category_value(lines(spark, data)).collect()}
    assert got["m01", "10"]["aov"] == 50.01  # 50.005 rounds up
    assert got["m01", "10"]["cv_ratio"] == 0.667
    assert got["m02", "10"]["aov"] is None and got["m02", "10"]["cv_ratio"] is None


def test_purchase_time_ties_set_both_flags_and_no_festival_none(spark):
    data = [line(rec=f"r{i}", day=START + dt.timedelta(i)) for i in range(7)]
    weekend = spark.createDataFrame([(D(2023, 7, 22),), (D(2023, 7, 23),)], "start_date date")
    got = ft.purchase_time(lines(spark, data), weekend, START, END).first()
    assert (got["weekday"], got["weekend"], got["morning"]) == ("1", "1", 7)
    none = spark.createDataFrame([], "start_date date")
    got = ft.purchase_time(lines(spark, data), none, START, END).first()
    assert (got["weekday"], got["weekend"]) == ("0", "0")


def test_receipt_counts_once_per_time(spark):
    data = [line(), line(units=5), line(time="090000")]
    got = ft.purchase_time(lines(spark, data), spark.createDataFrame([], "start_date date"), START, END)
    assert got.first()["morning"] == 2


def test_day_parts(spark):
    times = ["04", "05", "10", "11", "14", "15", "16", "17", "20", "21", "24", "25", "00"]
    df = spark.createDataFrame([(t + "0000",) for t in times], "t string")
    got = [r[0] for r in df.select(places.day_part(F.col("t"))).collect()]
    assert got == [
        "midnight", "morning", "morning", "noon", "noon", "afternoon", "afternoon", "night", "night",
        "midnight", "midnight", None, "midnight",
    ]


def test_address_cities(spark):
    data = ["新竹市東區中正路", "台北市大安區路", "屏東縣三地門鄉路", "高雄市中正路4號", "Harbour 5", None]
    df = spark.createDataFrame([(a,) for a in data], "a string")
    cities = [r[0] for r in df.select(places.address_city(F.col("a"))).collect()]
    assert cities == ["新竹市", "臺北市", "屏東縣", "高雄市", "X", "X"]


def stores(spark):
    data = [
        ("1", "100", "新竹市東區路", "01", D(2000, 1, 1), "2001-01-01", "0"),
        ("1", "100", "高雄市中正路4號", "02", D(2001, 1, 1), "9999-12-31", "0"),
        ("2", "200", "花蓮縣花蓮市路", "03", D(2000, 1, 1), "9999-12-31", "0"),
        ("3", "300", "Harbour", "04", D(2000, 1, 1), "9999-12-31", "0"),
        ("4", "200", "臺中市西區路", "04", D(2005, 1, 1), "9999-12-31", "0"),
        ("5", "500", "台北市大安區路", "04", D(2005, 1, 1), "9999-12-31", "1"),
    ]
    return spark.createDataFrame(data, SCHEMAS["store"])


def test_store_fallback_uses_newest_version_of_the_old_number(spark):
    data = [line(store=s) for s in ("1", "2", "3", "200", "999", "5")]
    got = {r["store_no"]: r["city"] for r in ft.store_city_fallback(lines(spark, data), stores(spark)).collect()}
    assert got == {"1": "高雄市", "2": "花蓮縣", "3": "X", "200": "臺中市", "999": None, "5": None}
    both = ft.store_city_fallback(lines(spark, [line(store="200")]), stores(spark), compat=True)
    assert sorted(r["city"] for r in both.collect()) == ["臺中市", "花蓮縣"]


def test_active_city_marks(spark):
    data = [("m1", "a", "s", "高雄市", 3), ("m1", "a", "t", "臺南市", 3), ("m1", "a", "u", "臺北市", 1),
            ("m2", "a", "s", "高雄市", 2), ("m2", "a", "t", "臺北市", 2),
            ("m3", "a", "s", "X", 5), ("m3", "a", "t", "臺北市", 1),
            ("m4", "a", "s", "花蓮縣", 1)]
    df = spark.createDataFrame(data, "mid string, pma_no_fin string, store_no string, city string, n_lines long")
    got = {r["mid"]: (r["active_city"], r["active_region"]) for r in ft.active_city_region(df).collect()}
    assert got == {
        "m1": (places.CROSS_CITY, "南部"),
        "m2": (places.CROSS_CITY, places.CROSS_REGION),
        "m3": ("X", places.CROSS_REGION),
        "m4": ("花蓮縣", "東部"),
    }
    compat = rows(ft.active_city_region(df, compat=True))
    assert [r[0] for r in compat] == ["m1", "m2", "m2", "m4"]  # m3 disappears, m2 twice


def test_member_features_keeps_city_only_in_its_own_scope(spark):
    data = [line(pma="54"), line(pma="10")]
    members = spark.createDataFrame([("m01", D(1990, 1, 1), "台北", "1")], SCHEMAS["member"])
    weekend = spark.createDataFrame([(D(2023, 7, 22),)], "start_date date")
    got = member_features(members, lines(spark, data), weekend, stores(spark), START, 7, D(2023, 8, 1))
    by = {r["pma_no_fin"]: r for r in got.collect()}
    assert by["54"]["active_city"] is None and by["10"]["active_city"] == "高雄市"
    assert by["10"]["area_02"] == 1 and by["10"]["rfm_recency"] == 6 and by["10"]["age"] == 33


def test_no_cartesian_product_in_the_feature_plan(spark):
    import __spark_entry__ as entry

    plan = entry.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "PushedFilters" in plan or "FileScan" in plan


def test_tasks_of_lines_follow_their_number(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(views, "LINE_ROWS", 500, raising=False)
    pos = views.pos_lines(spark, folder)
    assert pos.rdd.getNumPartitions() == -(-spark.read.parquet(f"{folder}/lineitem.parquet").count() // 500)


def _odd_lines(spark):
    """Receipts over several dates and stores, a missing receipt number and a very active member."""
    data = [line(mid=f"m{i % 7:02}", pma=str(10 + i % 3), rec=f"r{i % 11}", day=START + dt.timedelta(days=i % 5), store=str(i % 6)) for i in range(90)]
    data += [line(mid="m01", pma="10", rec=f"s{i}", store="999") for i in range(200)] + [line(rec=None)]
    return lines(spark, data).repartition(13, "rec_no")  # as pos_lines deals them


def test_fixed_tasks_give_the_same_features_and_hold_for_every_exchange(spark, monkeypatch):
    members = spark.createDataFrame([(f"m{i:02}", D(1990, 1, 1 + i), "台北", "1") for i in range(7)], SCHEMAS["member"])
    weekend = spark.createDataFrame([(D(2023, 7, 22),)], "start_date date")
    made = lambda tasks: member_features(members, _odd_lines(spark), weekend, stores(spark), START, 7, D(2023, 8, 1), tasks=tasks)
    plain = rows(made(None))
    assert len(plain) > 15 and rows(made(13)) == plain
    monkeypatch.setattr("tillroll.plans.member_features.small", lambda df: df)  # stores too many for a broadcast
    dealt = made(13)
    assert rows(dealt) == plain
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    keyed = re.findall(r"Exchange hashpartitioning\((?:mid|store_no)[^)]*, (\d+)\), REPARTITION_BY_NUM", plan)
    assert len(keyed) >= 8 and set(keyed) == {"13"}
    merged = re.findall(r"Exchange hashpartitioning\(([^)]*), 4\), ENSURE_REQUIREMENTS", plan)
    assert not [k for k in merged if k.startswith("mid")], merged


def test_lines_meet_their_parts_in_tasks_fixed_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(views, "LINE_ROWS", 500, raising=False)
    folder = "/root/testdata/sf0.001"
    n = -(-spark.read.parquet(f"{folder}/lineitem.parquet").count() // 500)
    plan = views.pos_lines(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"hashpartitioning\(l_partkey[^)]*, {n}\), REPARTITION_BY_NUM", plan)


def test_lines_of_a_very_frequent_part_pass_its_task_unsorted(spark, tmp_path):
    lines_of = [(o, 1 if o % 4 else o % 7, 5 + o % 3, 2.0, 10.0) for o in range(40)] + [(3, None, 5, 1.0, 1.0)]
    given = {
        "lineitem": (lines_of, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double"),
        "orders": ([(o, o % 5, D(1996, 1, 1), "F") for o in range(40)], "o_orderkey long, o_custkey long, o_orderdate date, o_orderstatus string"),
        "part": ([(1, "A"), (1, "B"), (2, "C"), (None, "D")], "p_partkey long, p_type string"),  # one number twice
    }
    for name, (data, schema) in given.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    pos = views.pos_lines(spark, str(tmp_path))
    types = {1: ["A", "B"], 2: ["C"]}
    want = sorted((x[0], t) for x in lines_of for t in types.get(x[1], []))
    assert sorted((r["rec_no"], r["pma_no_fin"]) for r in pos.collect()) == want
    plan = views.pos_lines(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [l_partkey" in plan and "Sort [l_partkey" not in plan
