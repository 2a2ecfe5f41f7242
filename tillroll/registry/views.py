"""The warehouse tables derived from the given tables, as DataFrames and as SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import features as ft
from tillroll.session import is_local
from tillroll.sources.tables import read_table

TODAY = dt.date(2024, 2, 1)
START = dt.date(1995, 1, 1)
WINDOW_DAYS = 2410  # covers every order date
END = START + dt.timedelta(days=WINDOW_DAYS - 1)
EVENT_START = dt.date(2024, 1, 1)
EVENT_DAYS = 30
EVENT_END = EVENT_START + dt.timedelta(days=EVENT_DAYS - 1)

ADDRESSES = [
    "新竹市東區中正路1號",
    "台北市大安區和平路2號",
    "屏東縣三地門鄉中山路3號",
    "高雄市中正路4號",
    "Harbour Road 5",
    "花蓮縣花蓮市中央路6號",
]


LARGE = {"lineitem", "documents", "pages", "conversations", "part", "embeddings"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table.  On one machine, a large one in a single file is dealt out to the cores."""
    df = read_table(spark, f"{sf}/{name}.parquet")
    if name not in LARGE or not is_local(spark):
        return df
    cores = spark.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores)


#: Rows of a task whose work is heavy for the bytes of its row, as the parse of a page built from it.
DEALT_ROWS = 10_000


#: Lines of a task that groups them; its memory grows with them.
LINE_ROWS = 250_000


def dealt(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table whose rows are few bytes but long work, dealt out by their number on any machine.

    Parquet is split by bytes and row groups, so such a table would be one task at a million rows.
    """
    df = read_table(spark, f"{sf}/{name}.parquet")
    return df.repartition(_tasks(df, DEALT_ROWS))


def _tasks(df: DataFrame, rows: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def _code(column: str) -> F.Column:
    return F.lpad(F.col(column).cast("string"), 9, "0")


def members(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    days = (F.col("c_custkey") * 37 % 36500).cast("int")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        _code("c_custkey").alias("mid"),
        F.date_add(F.lit(dt.date(1920, 1, 1)), days).alias("birthday"),
        F.concat(F.lit("台"), "n_name").alias("home_city"),
        (F.col("c_custkey") % 2).cast("string").alias("gender"),
    )


V_MEMBER = """v_member AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS mid,
         DATE '1920-01-01' + CAST(c_custkey * 37 % 36500 AS INTEGER) AS birthday,
         '台' || n_name AS home_city, CAST(c_custkey % 2 AS VARCHAR) AS gender
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def line_tasks(spark: SparkSession, sf: str) -> int:
    """Tasks of the lines: their number, not their bytes, fixes it."""
    return _tasks(read_table(spark, f"{sf}/lineitem.parquet"), LINE_ROWS)


def pos_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with their order and part, in tasks of about ``LINE_ROWS`` lines by the key of the order.

    The number of tasks is fixed by the rows, also where lines meet their parts: partitions merged by bytes
    hold ever more lines, as these shrink to a few bytes each.  Receipts are then grouped where their lines lie.
    The parts of a task are hashed and its lines pass by unsorted, so those of a very frequent part take no memory.
    """
    line = read_table(spark, f"{sf}/lineitem.parquet")
    orders = read_table(spark, f"{sf}/orders.parquet")
    part = read_table(spark, f"{sf}/part.parquet")
    n = line_tasks(spark, sf)
    store = F.when(F.col("l_suppkey") % 5 == 0, F.col("l_suppkey") + 100000).otherwise(
        F.col("l_suppkey")
    )
    return (
        line.repartition(n, "l_partkey")
        .join(part.repartition(n, "p_partkey").hint("shuffle_hash"), F.col("l_partkey") == F.col("p_partkey"))
        .repartition(n, "l_orderkey")
        .join(orders.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            _code("o_custkey").alias("mid"),
            F.col("p_type").alias("pma_no_fin"),
            F.col("l_orderkey").alias("rec_no"),
            F.col("o_orderdate").cast("date").alias("data_date"),
            F.concat(
                F.lpad((F.col("l_orderkey") % 24).cast("string"), 2, "0"), F.lit("0000")
            ).alias("sale_time"),
            store.cast("string").alias("store_no"),
            F.when(F.col("o_orderstatus") == "P", "01").otherwise("23").alias("job_id"),
            F.col("l_quantity").cast("int").alias("item_cont"),
            F.col("l_extendedprice").alias("mm_sales"),
        )
    )


V_POS = """v_pos AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS mid, p_type AS pma_no_fin,
         l_orderkey AS rec_no, CAST(o_orderdate AS DATE) AS data_date,
         lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || '0000' AS sale_time,
         CAST(CASE WHEN l_suppkey % 5 = 0 THEN l_suppkey + 100000 ELSE l_suppkey END AS VARCHAR)
           AS store_no,
         CASE WHEN o_orderstatus = 'P' THEN '01' ELSE '23' END AS job_id,
         CAST(l_quantity AS INTEGER) AS item_cont,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS mm_sales
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

EXCLUDED_SQL = f"({', '.join(map(repr, ft.EXCLUDED))})"
EXCLUDED_CITY_SQL = f"({', '.join(map(repr, ft.EXCLUDED_FOR_CITY))})"


def _scope_sql(name: str, excluded: str) -> str:
    return f"""{name} AS (
  SELECT * FROM v_pos
  WHERE data_date BETWEEN DATE '{START}' AND DATE '{END}' AND job_id = '23'
    AND pma_no_fin NOT IN {excluded}
    AND mid IN (SELECT mid FROM v_member WHERE length(mid) > 2))"""


V_SCOPE = _scope_sql("v_scope", EXCLUDED_SQL)
V_CITY_SCOPE = _scope_sql("v_city_scope", EXCLUDED_CITY_SQL)


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").alias("mid"),
        F.col("event_type").alias("pma_no_fin"),
        F.col("event_id").alias("rec_no"),
        F.col("ts").cast("date").alias("data_date"),
        F.date_format("ts", "HHmmss").alias("sale_time"),
    )


V_EVENT = """v_event AS (
  SELECT user_id AS mid, event_type AS pma_no_fin, event_id AS rec_no,
         CAST(ts AS DATE) AS data_date, strftime(ts, '%H%M%S') AS sale_time
  FROM events)"""


def festivals(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates that fall on a Saturday or Sunday."""
    return _weekend_days(table(spark, sf, "orders"), "o_orderdate")


def event_festivals(spark: SparkSession, sf: str) -> DataFrame:
    return _weekend_days(table(spark, sf, "events"), "ts")


def _weekend_days(df: DataFrame, column: str) -> DataFrame:
    day = F.col(column).cast("date")
    return (
        df.select(day.alias("start_date")).distinct().filter(F.weekday("start_date").isin(5, 6))
    )


V_FESTIVAL = """v_festival AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS start_date FROM orders
  WHERE isodow(o_orderdate) IN (6, 7))"""
V_EVENT_FESTIVAL = """v_event_festival AS (
  SELECT DISTINCT CAST(ts AS DATE) AS start_date FROM events WHERE isodow(ts) IN (6, 7))"""


def stores(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions of every store, the first closed, the other two open in different areas."""
    supplier = table(spark, sf, "supplier")
    version = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("v")
    address = F.get(
        F.array(*[F.lit(a) for a in ADDRESSES]), (F.col("s_nationkey") + F.col("v")) % 6
    )
    area = (F.col("s_nationkey") + F.when(F.col("v") == 2, 3).otherwise(0)) % 11 + 1
    return supplier.select("*", version).select(
        F.col("s_suppkey").cast("string").alias("store_no"),
        (F.col("s_suppkey") + 100000).cast("string").alias("old_store_no"),
        address.alias("address"),
        F.lpad(area.cast("string"), 2, "0").alias("master_area_no"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("v") * 365).alias("eff_date_from"),
        F.when(F.col("v") == 0, "2000-12-30").otherwise("9999-12-31").alias("eff_date_to"),
        F.lit("0").alias("store_test_flag"),
    )


_ADDRESS_CASE = " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(ADDRESSES))
V_STORE = f"""v_store AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS store_no, CAST(s_suppkey + 100000 AS VARCHAR) AS old_store_no,
         CASE (s_nationkey + v) % 6 {_ADDRESS_CASE} END AS address,
         lpad(CAST((s_nationkey + CASE v WHEN 2 THEN 3 ELSE 0 END) % 11 + 1 AS VARCHAR), 2, '0') AS master_area_no,
         DATE '2000-01-01' + v * 365 AS eff_date_from,
         CASE v WHEN 0 THEN '2000-12-30' ELSE '9999-12-31' END AS eff_date_to,
         '0' AS store_test_flag
  FROM supplier, (VALUES (0), (1), (2)) versions(v))"""


def areas(spark: SparkSession, sf: str) -> DataFrame:
    code = F.lpad((F.col("n_nationkey") % 11 + 1).cast("string"), 2, "0")
    return (
        table(spark, sf, "nation")
        .select(code.alias("master_area_no"))
        .select(
            "master_area_no",
            F.concat(F.lit("AREA_"), "master_area_no", F.lit("---rest")).alias("area_name"),
            F.lit("9999-12-31").alias("eff_date_to"),
        )
    )


V_AREA = """v_area AS (
  SELECT lpad(CAST(n_nationkey % 11 + 1 AS VARCHAR), 2, '0') AS master_area_no,
         'AREA_' || lpad(CAST(n_nationkey % 11 + 1 AS VARCHAR), 2, '0') || '---rest' AS area_name,
         '9999-12-31' AS eff_date_to
  FROM nation)"""

# City of the newest version of every store: `key` is store_no or old_store_no.
CITY_CASE = """replace(CASE WHEN substring(address, 3, 1) IN ('縣', '市')
    THEN substring(address, 1, 3) ELSE 'X' END, '台', '臺')"""


def store_city_sql(name: str, key: str, rank_by: str) -> str:
    return f"""{name} AS (
  SELECT {key}, {CITY_CASE} AS city
  FROM (SELECT arg_max({key}, eff_date_from) AS {key}, arg_max(address, eff_date_from) AS address
        FROM v_store WHERE store_test_flag = '0' GROUP BY {rank_by}))"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
