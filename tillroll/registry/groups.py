"""Preparation and profile queries over the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions import rfm
from tillroll.operators import features as ft
from tillroll.operators import prepare as pr
from tillroll.operators import profile as pf
from tillroll.registry import views as v
from tillroll.registry.base import query, sql_round
from tillroll.registry.relational import RFM, SCOPE_VIEWS, SUMS, feature_views, features, rfm_rows
from tillroll.session import materialize



def feature_table(spark, sf):
    """The feature table, written once as the statement of the warehouse does."""
    return materialize(features(spark, sf))


FEATURES = v.with_views(*feature_views())
LEVEL_CASE = " ".join(f"WHEN '{k}' THEN '{n}'" for k, n in rfm.LEVEL_NAMES.items())


def level_sql(r_split: str, f_split: str, m_split: str, level: str, named: bool) -> str:
    name = f", CASE rfm_level {LEVEL_CASE} END AS level_name" if named else ""
    return (
        v.with_views(*SCOPE_VIEWS, SUMS, RFM)
        + f"""SELECT mid, pma_no_fin, rfm_level{name} FROM (
  SELECT r.mid, r.pma_no_fin, {level} AS rfm_level FROM visit_value r JOIN (
    SELECT pma_no_fin, {r_split} AS rs, {f_split} AS fs, {m_split} AS ms
    FROM visit_value GROUP BY pma_no_fin) s ON r.pma_no_fin = s.pma_no_fin) t"""
    )


R = "CASE WHEN rfm_recency <= rs THEN '1' ELSE '0' END"
FQ = "CASE WHEN rfm_frequency >= fs THEN '1' ELSE '0' END"
M = "CASE WHEN rfm_monetary >= ms THEN '1' ELSE '0' END"


def all_three(fn: str) -> tuple[str, str, str]:
    return f"{fn}(rfm_recency)", f"{fn}(rfm_frequency)", f"{fn}(rfm_monetary)"


def levels(spark, sf, how, letters=None):
    base = materialize(rfm_rows(spark, sf))
    out = pr.rfm_levels(base, how, letters)
    out = out.select("mid", "pma_no_fin", "rfm_level")
    return out if letters else out.withColumn("level_name", rfm.level_name(F.col("rfm_level")))


@query("rfm_level_mean", level_sql(*all_three("avg"), f"{R} || {FQ} || {M}", True))
def q_rfm_level_mean(spark, sf):
    return levels(spark, sf, "average")


@query("rfm_level_median", level_sql(*all_three("median"), f"{R} || {FQ} || {M}", True))
def q_rfm_level_median(spark, sf):
    return levels(spark, sf, "median")


@query("rfm_level_two", level_sql(*all_three("avg"), f"{R} || {M}", False))
def q_rfm_level_two(spark, sf):
    return levels(spark, sf, "average", ["m", "r"])


def _mode(column: str) -> str:
    return f"""(SELECT x FROM (SELECT {column} AS x, count(*) AS n FROM visit_value i
      WHERE i.pma_no_fin = o.pma_no_fin GROUP BY 1 ORDER BY n DESC, x LIMIT 1) q)"""


@query(
    "rfm_level_mode",
    v.with_views(*SCOPE_VIEWS, SUMS, RFM)
    + f"""SELECT mid, pma_no_fin, rfm_level, CASE rfm_level {LEVEL_CASE} END AS level_name FROM (
  SELECT r.mid, r.pma_no_fin, {R} || {FQ} || {M} AS rfm_level FROM visit_value r JOIN (
    SELECT pma_no_fin, {_mode("rfm_recency")} AS rs, {_mode("rfm_frequency")} AS fs,
           {_mode("rfm_monetary")} AS ms
    FROM (SELECT DISTINCT pma_no_fin FROM visit_value) o) s ON r.pma_no_fin = s.pma_no_fin) t""",
)
def q_rfm_level_mode(spark, sf):
    return levels(spark, sf, "mode")


@query(
    "rfm_split",
    v.with_views(*SCOPE_VIEWS, SUMS, RFM)
    + f"""SELECT pma_no_fin, {sql_round("avg(rfm_recency)", 4)} AS mean_recency,
  {sql_round("avg(rfm_monetary)", 4)} AS mean_monetary,
  {sql_round("median(rfm_recency)", 4)} AS median_recency,
  {sql_round("median(rfm_monetary)", 4)} AS median_monetary
FROM visit_value GROUP BY pma_no_fin""",
)
def q_rfm_split(spark, sf):
    base = materialize(rfm_rows(spark, sf))
    half = [F.col(f"rfm_{x}_split") for x in ("recency", "monetary")]
    rounded = [F.round(c.cast("decimal(28,10)"), 4).cast("double") for c in half]
    parts = [
        pr.rfm_splits(base, how).select(
            "pma_no_fin", *[c.alias(f"{name}_{x}") for c, x in zip(rounded, ("recency", "monetary"))]
        )
        for how, name in (("average", "mean"), ("median", "median"))
    ]
    return parts[0].join(parts[1], "pma_no_fin")


SELECTED_GROUPS = ["personal", "rfm", "active"]
SELECTED = ", ".join(name for name, _ in pr.feature_columns(SELECTED_GROUPS))


@query("feature_select", FEATURES + f"SELECT {SELECTED} FROM features")
def q_feature_select(spark, sf):
    return pr.select_features(features(spark, sf), SELECTED_GROUPS)


@query(
    "null_fill",
    FEATURES
    + """SELECT mid, pma_no_fin, qty, avg_qty, coalesce(sex, ' ') AS sex, coalesce(age, 0) AS age,
  coalesce(home_city, ' ') AS home_city, coalesce(active_city, ' ') AS active_city,
  coalesce(active_region, ' ') AS active_region FROM features""",
)
def q_null_fill(spark, sf):
    return pr.fill_missing(pr.select_features(features(spark, sf), ["personal", "active"]))


@query(
    "null_count",
    FEATURES
    + """SELECT count(*) FILTER (WHERE age IS NULL) AS age,
  count(*) FILTER (WHERE active_city IS NULL) AS active_city,
  count(*) FILTER (WHERE area_01 IS NULL) AS area_01 FROM features""",
)
def q_null_count(spark, sf):
    return pf.null_counts(features(spark, sf), ["age", "active_city", "area_01"])


CODED = ["sex", "home_city", "active_city", "active_region"]
_CODES = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {c} AS value,
  CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT coalesce({c}, ' ') AS {c} FROM features) t"""
    for c in CODED
)


def coded_features(spark, sf):
    return pr.fill_missing(pr.select_features(feature_table(spark, sf), ["personal", "active"]))


@query("label_codes", FEATURES + _CODES)
def q_label_codes(spark, sf):
    return pr.label_codes(coded_features(spark, sf), CODED)


def _rank(c: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY coalesce({c}, ' ')) - 1 AS INTEGER) AS {c}"


@query(
    "label_encode",
    FEATURES + f"SELECT mid, pma_no_fin, {', '.join(map(_rank, CODED))} FROM features",
)
def q_label_encode(spark, sf):
    df = coded_features(spark, sf).select("mid", "pma_no_fin", *CODED)
    return pr.encode_labels(df, pr.label_codes(df, CODED), CODED)


@query(
    "label_decode",
    FEATURES + "SELECT mid, pma_no_fin, coalesce(active_city, ' ') AS active_city FROM features",
)
def q_label_decode(spark, sf):
    df = coded_features(spark, sf).select("mid", "pma_no_fin", "active_city")
    codes = pr.label_codes(df, ["active_city"])
    return pr.decode_labels(
        pr.encode_labels(df, codes, ["active_city"]), codes, ["active_city"]
    )


# A label that both engines can compute: the last digit of the member number, halved.
def grouped(spark, sf):
    label = (F.substring("mid", 9, 1).cast("int") / 2).cast("int")
    return feature_table(spark, sf).withColumn("label", label)


GROUPED = (
    FEATURES.rstrip()
    + """,
grouped AS (SELECT *, CAST(floor(CAST(substring(mid, 9, 1) AS INTEGER) / 2) AS INTEGER) AS label
            FROM features)
"""
)


@query(
    "group_size",
    GROUPED
    + f"""SELECT label, count(*) AS cnt,
  {sql_round("100.0 * count(*) / (SELECT count(*) FROM grouped)", 2)} AS pct
FROM grouped GROUP BY label""",
)
def q_group_size(spark, sf):
    return pf.group_size(grouped(spark, sf))


@query(
    "run_summary",
    GROUPED
    + f"""SELECT 'KMeans' AS method, (SELECT count(*) FROM grouped) AS data_length, label,
  count(*) AS cnt, {sql_round("100.0 * count(*) / (SELECT count(*) FROM grouped)", 2)} AS pct
FROM grouped GROUP BY label""",
)
def q_run_summary(spark, sf):
    return pf.run_summary(grouped(spark, sf), {"method": "KMeans"})


NUMERIC = ["qty", "avg_qty", "rfm_recency", "rfm_frequency", "rfm_monetary", "age"]


def per_column(select: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT label, '{c}' AS "column", {select.replace("$", c)} FROM grouped GROUP BY label"""
        for c in NUMERIC
    )


def rounded(df, columns):
    return df.withColumns({c: F.round(F.col(c).cast("decimal(28,10)"), 4).cast("double") for c in columns})


@query(
    "group_describe",
    GROUPED
    + per_column(
        f"""{sql_round("avg($)", 4)} AS mean, {sql_round("stddev_samp($)", 4)} AS std,
  {sql_round("min($)", 4)} AS min, {sql_round("quantile_cont($, 0.25)", 4)} AS p25,
  {sql_round("quantile_cont($, 0.5)", 4)} AS p50, {sql_round("quantile_cont($, 0.75)", 4)} AS p75,
  {sql_round("max($)", 4)} AS max"""
    ),
)
def q_group_describe(spark, sf):
    out = pf.group_describe(grouped(spark, sf), NUMERIC)
    return rounded(out, ["mean", "std", "min", "p25", "p50", "p75", "max"])


@query(
    "group_mean_std",
    GROUPED
    + per_column(f"{sql_round('avg($)', 4)} AS mean, {sql_round('stddev_pop($)', 4)} AS std"),
)
def q_group_mean_std(spark, sf):
    return rounded(pf.group_mean_std(grouped(spark, sf), NUMERIC), ["mean", "std"])


SHARED = ["sex", "active_city", "active_region"]
_SHARES = " UNION ALL ".join(
    f"""SELECT label, '{c}' AS "column", coalesce({c}, ' ') AS value, count(*) AS cnt
  FROM grouped GROUP BY 1, 2, 3"""
    for c in SHARED
)


@query(
    "value_share",
    GROUPED
    + f"""SELECT label, "column", value, cnt, {sql_round("100.0 * cnt / (rows - null_cnt)", 2)} AS pct,
  CAST(null_cnt AS BIGINT) AS null_cnt, {sql_round("100.0 * null_cnt / rows", 0)} AS null_pct
FROM (SELECT *, sum(cnt) OVER (PARTITION BY label, "column") AS rows,
             sum(CASE WHEN value = ' ' THEN cnt ELSE 0 END)
               OVER (PARTITION BY label, "column") AS null_cnt
      FROM ({_SHARES}) s) t WHERE value <> ' '""",
)
def q_value_share(spark, sf):
    return pf.value_share(grouped(spark, sf), SHARED)


_AREA_COLUMNS = [f"area_{c}" for c in ft.AREA_CODES]
_AREA_SUMS = " UNION ALL ".join(
    f"SELECT label, '{c}' AS master_area_no, CAST(sum(area_{c}) AS BIGINT) AS visits "
    "FROM grouped GROUP BY label"
    for c in ft.AREA_CODES
)


@query(
    "area_ratio",
    GROUPED.rstrip()
    + f""",
{v.V_AREA}
SELECT label, s.master_area_no, master_area_name, visits,
  {sql_round("visits / cnt * 100", 4)} AS ratio
FROM ({_AREA_SUMS}) s
JOIN (SELECT DISTINCT master_area_no, split_part(area_name, '---', 1) AS master_area_name
      FROM v_area) n ON s.master_area_no = n.master_area_no
LEFT JOIN (SELECT master_area_no, CAST(count(*) AS DOUBLE) AS cnt FROM v_store
      WHERE eff_date_to = '9999-12-31' GROUP BY 1) k ON s.master_area_no = k.master_area_no""",
)
def q_area_ratio(spark, sf):
    counts = ft.area_store_count(v.areas(spark, sf), v.stores(spark, sf))
    return pf.area_ratio(grouped(spark, sf), counts, _AREA_COLUMNS)


@query(
    "weekday_preference",
    GROUPED
    + f"""SELECT label, preference, cnt, {sql_round("100.0 * cnt / total", 2)} AS pct FROM (
  SELECT label, 'weekday' AS preference, CAST(sum(CAST(weekday AS INTEGER)) AS BIGINT) AS cnt,
         sum(CAST(weekday AS INTEGER)) + sum(CAST(weekend AS INTEGER)) AS total
  FROM grouped GROUP BY label
  UNION ALL
  SELECT label, 'weekend', CAST(sum(CAST(weekend AS INTEGER)) AS BIGINT),
         sum(CAST(weekday AS INTEGER)) + sum(CAST(weekend AS INTEGER))
  FROM grouped GROUP BY label) t""",
)
def q_weekday_preference(spark, sf):
    return pf.preference_share(grouped(spark, sf))
