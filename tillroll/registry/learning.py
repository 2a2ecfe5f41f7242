"""Segmentation, clustering quality and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions.numbers import half_up
from tillroll.operators import boosting as bt
from tillroll.operators import clustering as cl
from tillroll.operators import density as dn
from tillroll.operators import features as ft
from tillroll.operators import keywords as kw
from tillroll.operators import learning as ln
from tillroll.operators import names as nm
from tillroll.operators import neighbours as nb
from tillroll.operators import taxonomy as tx
from tillroll.operators import terms as tm
from tillroll.operators.prepare import Options
from tillroll.operators.ranking import dense_index
from tillroll.plans.product_classes import classify_products
from tillroll.plans.segmentation import segment
from tillroll.registry import views as v
from tillroll.registry.base import query, sql_round

from tillroll.registry.relational import SCOPE_VIEWS, SUMS, VALUE, feature_views, features, known, scope
from tillroll.registry.text import (
    CLUSTERS,
    KEYWORD_VIEWS,
    V_PRODUCT,
    clean_sql,
    products,
    tokened,
    tokens_sql,
    wide_top,
)
from tillroll.session import materialize

# --- quality of given labels -------------------------------------------------------------------

AXES = ["qty", "aov", "cv_ratio"]
KS = list(range(2, 9))


def value_rows(spark, sf):
    return known(spark, sf, ft.category_value(scope(spark, sf)))


def banded(df, k: int):
    """Label by equal bands of the units, the same rule as in the SQL."""
    top = df.agg(F.max("qty").alias("top"))
    band = F.least(F.lit(k - 1), F.floor(F.col("qty") * k / (F.col("top") + 1)).cast("int"))
    return df.crossJoin(F.broadcast(top)).withColumn("label", band)  # one row


_POINTS = ",\n".join(
    [
        f"""banded AS (
  SELECT k, CAST(least(k - 1, floor(CAST(qty AS DOUBLE) * k / (SELECT max(qty) + 1 FROM member_value))) AS INTEGER) AS label,
         CAST(qty AS DOUBLE) AS x1, aov AS x2, cv_ratio AS x3
  FROM member_value, (SELECT unnest([{", ".join(map(str, KS))}]) AS k) ks)""",
        """centre AS (
  SELECT k, label, count(*) AS n, avg(x1) AS c1, avg(x2) AS c2, avg(x3) AS c3
  FROM banded GROUP BY k, label)""",
        """gap AS (
  SELECT b.k, b.label, pow(x1 - c1, 2) + pow(x2 - c2, 2) + pow(x3 - c3, 2) AS g
  FROM banded b JOIN centre c ON b.k = c.k AND b.label = c.label)""",
        """spread AS (
  SELECT c.k, c.label, any_value(n) AS n, any_value(c1) AS c1, any_value(c2) AS c2,
         any_value(c3) AS c3, sum(g) AS ss, avg(sqrt(g)) AS s
  FROM centre c JOIN gap g ON c.k = g.k AND c.label = g.label GROUP BY c.k, c.label)""",
        """middle AS (
  SELECT k, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, count(*) AS total FROM banded GROUP BY k)""",
        """summed AS (
  SELECT s.k, count(*) AS kk, any_value(total) AS total, sum(ss) AS inside, min(n) AS smallest,
         sum(n * (pow(c1 - m1, 2) + pow(c2 - m2, 2) + pow(c3 - m3, 2))) AS between_,
         sum(n * ln(n) - n * ln(total) - n * 3.0 / 2 * ln(2 * pi() * ss / nullif(n - 1, 0)) - (n - 1) / 2.0) AS lik
  FROM spread s JOIN middle m ON s.k = m.k GROUP BY s.k)""",
        """db AS (
  SELECT k, avg(r) AS db FROM (
    SELECT a.k, a.label, max((a.s + b.s) / sqrt(pow(a.c1 - b.c1, 2) + pow(a.c2 - b.c2, 2)
           + pow(a.c3 - b.c3, 2))) AS r
    FROM spread a JOIN spread b ON a.k = b.k AND a.label <> b.label GROUP BY a.k, a.label) t
  GROUP BY k)""",
        """scored AS (
  SELECT k, 'elbow' AS metric, inside AS value FROM summed
  UNION ALL
  SELECT k, 'calinski-harabasz', between_ * (total - kk) / (inside * (kk - 1)) FROM summed
  UNION ALL SELECT k, 'davies-bouldin', db FROM db
  UNION ALL SELECT k, 'bic', CASE WHEN smallest <= 1 THEN NULL
    ELSE lik - ((kk - 1) + 3 * kk + 1) / 2.0 * ln(total) END FROM summed)""",
    ]
)
SCORED = v.with_views(*SCOPE_VIEWS, SUMS, VALUE, _POINTS)


def scores(spark, sf):
    rows = materialize(value_rows(spark, sf))
    return cl.score_grid({k: (banded(rows, k), None) for k in KS}, AXES, spark)


@query(
    "k_scores",
    SCORED
    + f"""SELECT CAST(k AS INTEGER) AS k, metric,
  {sql_round("CASE WHEN metric = 'elbow' THEN value / 1000000 ELSE value END", 2)} AS value FROM scored""",
)
def q_k_scores(spark, sf):
    millions = F.when(F.col("metric") == "elbow", F.col("value") / 1000000).otherwise(F.col("value"))
    return scores(spark, sf).withColumn("value", half_up(millions, 2))


@query(
    "best_k",
    SCORED.rstrip()
    + """,
curve AS (
  SELECT k, (hi - value) / (hi - lo) - (k - kl) / (kh - kl) AS gap, 1.0 / (n - 1) AS step
  FROM scored, (SELECT max(value) AS hi, min(value) AS lo, CAST(min(k) AS DOUBLE) AS kl,
                       CAST(max(k) AS DOUBLE) AS kh, count(*) AS n FROM scored WHERE metric = 'elbow') r
  WHERE metric = 'elbow'),
around AS (
  SELECT *, lag(gap) OVER (ORDER BY k) AS before, lead(gap) OVER (ORDER BY k) AS after FROM curve),
marked AS (
  SELECT *, gap >= coalesce(before, gap) AND gap >= coalesce(after, gap) AS top,
         gap <= coalesce(before, gap) AND gap <= coalesce(after, gap) AS bottom FROM around),
started AS (
  SELECT *, max(CASE WHEN top THEN 1 ELSE 0 END) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS begun
  FROM marked),
limits AS (
  SELECT k, after,
    last_value(CASE WHEN begun = 0 THEN NULL WHEN bottom THEN 0.0 WHEN top THEN gap - step END IGNORE NULLS)
      OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS lim,
    last_value(CASE WHEN top THEN k END IGNORE NULLS)
      OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS candidate
  FROM started),
indices AS (
  SELECT metric, first(k ORDER BY CASE WHEN metric = 'davies-bouldin' THEN value ELSE -value END, k) AS best_k
  FROM scored WHERE metric <> 'elbow' AND value IS NOT NULL GROUP BY metric)
SELECT metric, CAST(best_k AS INTEGER) AS best_k FROM (
  SELECT metric, best_k FROM indices
  UNION ALL
  SELECT 'elbow', coalesce((SELECT first(candidate ORDER BY k) FROM limits WHERE after < lim),
                           (SELECT best_k FROM indices WHERE metric = 'calinski-harabasz'))) t""",
)
def q_best_k(spark, sf):
    return cl.best_k(scores(spark, sf))


def quality_sql(metric: str, column: str, digits: int = 4) -> str:
    return SCORED + f"SELECT {sql_round('value', digits)} AS {column} FROM scored WHERE k = 5 AND metric = '{metric}'"


def one_score(spark, sf, metric: str, column: str, digits: int = 4):
    stats = cl.cluster_statistics(materialize(banded(value_rows(spark, sf), 5)), AXES)
    value = cl.quality(stats, len(AXES))[metric]
    out = spark.createDataFrame([(value,)], f"{column} double")
    return out.select(half_up(F.col(column), digits).alias(column))


@query("cluster_inertia", quality_sql("elbow", "inertia", 0))
def q_cluster_inertia(spark, sf):
    return one_score(spark, sf, "elbow", "inertia", 0)


@query("cluster_ch", quality_sql("calinski-harabasz", "ch"))
def q_cluster_ch(spark, sf):
    return one_score(spark, sf, "calinski-harabasz", "ch")


@query("cluster_db", quality_sql("davies-bouldin", "db"))
def q_cluster_db(spark, sf):
    return one_score(spark, sf, "davies-bouldin", "db")


@query("cluster_bic", quality_sql("bic", "bic"))
def q_cluster_bic(spark, sf):
    return one_score(spark, sf, "bic", "bic")


@query(
    "cluster_silhouette",
    SCORED.rstrip()
    + f""",
own AS (SELECT row_number() OVER () AS id, * FROM banded WHERE k = 5),
sums AS (
  SELECT label AS other, count(*) AS n, sum(x1) AS s1, sum(x2) AS s2, sum(x3) AS s3,
         sum(x1 * x1 + x2 * x2 + x3 * x3) AS q FROM own GROUP BY label),
apart AS (
  SELECT id, label, other, n, x1 * x1 + x2 * x2 + x3 * x3 + q / n - 2 * (x1 * s1 + x2 * s2 + x3 * s3) / n AS d
  FROM own, sums),
pair AS (
  SELECT id, max(CASE WHEN other = label THEN CASE n WHEN 1 THEN 0 ELSE d * n / (n - 1) END END) AS a,
         max(CASE WHEN other = label THEN n END) AS size, min(CASE WHEN other <> label THEN d END) AS b
  FROM apart GROUP BY id)
SELECT {sql_round("avg(CASE WHEN size = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END)", 4)} AS silhouette
FROM pair""".replace("sums AS (", "own_sums AS (").replace("FROM own, sums)", "FROM own, own_sums)"),
)
def q_cluster_silhouette(spark, sf):
    value = cl.silhouette(materialize(banded(value_rows(spark, sf), 5)), AXES)
    return spark.createDataFrame([(value,)], "silhouette double").select(half_up(F.col("silhouette"), 4).alias("silhouette"))


# --- fits --------------------------------------------------------------------------------------

COLUMNS = ["qty", "avg_qty", "rfm_recency", "rfm_frequency", "rfm_monetary"]
CATEGORIES = ["weekday", "weekend", "active_region", "sex"]


def fit_rows(spark, sf):
    keep = ["mid", "pma_no_fin", *COLUMNS, *CATEGORIES]
    return materialize(features(spark, sf).select(*keep).fillna(" ", CATEGORIES).fillna(0, COLUMNS))


ROUNDS = 4
GAMMA = 1000.0
_FIT_ROWS = f"""fit_rows AS (
  SELECT mid, pma_no_fin, {", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in COLUMNS)},
         {", ".join(f"coalesce({c}, ' ') AS {c}" for c in CATEGORIES)} FROM features)"""


def rounds_sql(numeric: list[str], categorical: list[str], k: int, weight: str = "1.0") -> str:
    """The fit unrolled: starting rows, then ``ROUNDS`` times labels and new centres."""
    columns = [*numeric, *categorical]
    gaps = [f"pow(r.{c} - m.{c}, 2)" for c in numeric]
    unlike = " + ".join(f"CASE WHEN r.{c} = m.{c} THEN 0 ELSE 1 END" for c in categorical)
    distance = " + ".join(gaps + ([f"{GAMMA if numeric else 1.0} * ({unlike})"] if categorical else []))
    views = [
        f"""centre_0 AS (
  SELECT row_number() OVER (ORDER BY {", ".join(columns)}) - 1 AS label, * FROM (
    SELECT DISTINCT {", ".join(columns)} FROM fit_rows ORDER BY ALL LIMIT {k}))"""
    ]
    for i in range(ROUNDS + 1):
        views.append(
            f"""near_{i} AS (
  SELECT r.mid, r.pma_no_fin, arg_min(m.label, ({distance}, m.label)) AS label
  FROM fit_rows r, centre_{i} m GROUP BY r.mid, r.pma_no_fin)"""
        )
        means = ", ".join(f"sum({c} * {weight}) / sum({weight}) AS {c}" for c in numeric)
        modes = ", ".join(
            f"""(SELECT {c} FROM (SELECT {c}, count(*) AS cnt FROM joined_{i} j WHERE j.label = g.label GROUP BY {c})
    ORDER BY cnt DESC, {c} LIMIT 1) AS {c}"""
            for c in categorical
        )
        views.append(f"joined_{i} AS (SELECT r.*, label FROM fit_rows r JOIN near_{i} USING (mid, pma_no_fin))")
        views.append(
            f"""centre_{i + 1} AS (
  SELECT label, {", ".join(x for x in (means, modes) if x)} FROM joined_{i} g GROUP BY label
  UNION ALL SELECT * FROM centre_{i} WHERE label NOT IN (SELECT label FROM near_{i}))"""
        )
    fit = v.with_views(*feature_views(), _FIT_ROWS, *views)
    return fit + f"SELECT mid, pma_no_fin, CAST(label AS INTEGER) AS label FROM near_{ROUNDS}"


@query("kmeans_labels", rounds_sql(COLUMNS, [], 5))
def q_kmeans_labels(spark, sf):
    labelled, _, _ = cl.kmeans(fit_rows(spark, sf), COLUMNS, 5, max_iter=ROUNDS, init="first")
    return labelled.select("mid", "pma_no_fin", "label")


@query("kmeans_weighted", rounds_sql(COLUMNS, [], 5, "qty"))
def q_kmeans_weighted(spark, sf):
    labelled, _, _ = cl.kmeans(fit_rows(spark, sf), COLUMNS, 5, max_iter=ROUNDS, weight="qty", init="first")
    return labelled.select("mid", "pma_no_fin", "label")


@query("kmodes_labels", rounds_sql([], CATEGORIES, 4))
def q_kmodes_labels(spark, sf):
    rows = fit_rows(spark, sf)
    return cl.kmodes(rows, CATEGORIES, 4, ROUNDS, init="first").label(rows).select("mid", "pma_no_fin", "label")


@query("kprototypes_labels", rounds_sql(COLUMNS, CATEGORIES, 4))
def q_kprototypes_labels(spark, sf):
    rows = fit_rows(spark, sf)
    model = cl.kprototypes(rows, COLUMNS, CATEGORIES, 4, GAMMA, ROUNDS, init="first")
    return model.label(rows).select("mid", "pma_no_fin", "label")


def medoids_sql(numeric: list[str], k: int) -> str:
    """The fit unrolled: ``ROUNDS`` times labels, and the row of each label with the smallest summed distance."""
    names = ", ".join(numeric)
    away = lambda a, b: f"sqrt({' + '.join(f'pow({a}.{c} - {b}.{c}, 2)' for c in numeric)})"
    views = [
        f"""centre_0 AS (
  SELECT row_number() OVER (ORDER BY {names}) - 1 AS label, * FROM (
    SELECT DISTINCT {names} FROM fit_rows ORDER BY ALL LIMIT {k}))"""
    ]
    for i in range(ROUNDS + 1):
        views.append(
            f"""near_{i} AS (
  SELECT r.*, arg_min(m.label, ({away("r", "m")}, m.label)) AS label
  FROM fit_rows r, centre_{i} m GROUP BY ALL)"""
        )
        views.append(
            f"""centre_{i + 1} AS (
  SELECT label, {names} FROM (
    SELECT a.label, {", ".join(f"a.{c}" for c in numeric)}, sum({away("a", "b")} * b.w) AS total
    FROM (SELECT DISTINCT label, {names} FROM near_{i}) a
    JOIN (SELECT label, {names}, count(*) AS w FROM near_{i} GROUP BY ALL) b USING (label) GROUP BY ALL) s
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY total, {names}) = 1
  UNION ALL SELECT * FROM centre_{i} WHERE label NOT IN (SELECT label FROM near_{i}))"""
        )
    fit = v.with_views(*feature_views(), _FIT_ROWS, *views)
    return fit + f"SELECT mid, pma_no_fin, CAST(label AS INTEGER) AS label FROM near_{ROUNDS}"


@query("kmedoids_labels", medoids_sql(COLUMNS, 4))
def q_kmedoids_labels(spark, sf):
    rows = fit_rows(spark, sf)
    model = cl.kmedoids(rows, COLUMNS, 4, max_iter=ROUNDS, init="first")
    return model.label(rows).select("mid", "pma_no_fin", "label")


@query("segmentation_run")
def q_segmentation_run(spark, sf):
    options = Options("KMeans", auto=True, score="calinski-harabasz", k_min=2, k_max=4, groups=("rfm", "prefer"))
    return segment(features(spark, sf), "ECONOMY", options).summary()


@query(
    "density_groups",
    """WITH RECURSIVE vec AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pair AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vec a JOIN vec b ON a.vec_id <> b.vec_id
         WHERE list_distance(a.e, b.e) <= 1.1),
core AS (SELECT a AS id FROM pair GROUP BY a HAVING count(*) + 1 >= 3),
link AS (SELECT a, b FROM pair WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach AS (SELECT id, id AS other FROM core
          UNION SELECT r.id, l.b FROM reach r JOIN link l ON r.other = l.a),
grouped AS (SELECT id, min(other) AS group_id FROM reach GROUP BY id),
border AS (SELECT a AS id, min(b) AS core_id FROM pair
           WHERE a NOT IN (SELECT id FROM core) AND b IN (SELECT id FROM core) GROUP BY a)
SELECT vec_id, coalesce(g.group_id, h.group_id, -1) AS group_id
FROM embeddings e LEFT JOIN grouped g ON e.vec_id = g.id
LEFT JOIN border b ON e.vec_id = b.id LEFT JOIN grouped h ON b.core_id = h.id""",
)
def q_density_groups(spark, sf):
    rows = v.table(spark, sf, "embeddings").select("vec_id", "embedding")
    return dn.density_groups(rows, 1.1, 3, "vec_id", "embedding")


# --- names -------------------------------------------------------------------------------------


NAME_ROUNDS, NAME_CLUSTERS = 3, 4


def name_rounds_sql() -> list[str]:
    """The clusters unrolled: the first names as centres, then labels and mean profiles in turns."""
    views = [
        f"toks AS (SELECT DISTINCT category, item_name, {tokens_sql('item_name')} AS t FROM v_product)",
        """counted AS (
  SELECT category, item_name, token, count(*) AS c FROM (SELECT category, item_name, unnest(t) AS token FROM toks)
  WHERE len(token) > 1 GROUP BY ALL)""",
        "cells AS (SELECT *, c / sqrt(sum(c * c) OVER (PARTITION BY category, item_name)) AS x FROM counted)",
        f"""firsts AS (
  SELECT category, item_name, row_number() OVER (PARTITION BY category ORDER BY item_name) - 1 AS label FROM toks
  QUALIFY label < {NAME_CLUSTERS})""",
        "centre_0 AS (SELECT category, label, token, x AS c FROM cells JOIN firsts USING (category, item_name))",
    ]
    for i in range(NAME_ROUNDS + 1):
        views += [
            f"""near_{i} AS (
  SELECT category, item_name, label, sum(x * m.c) AS s FROM cells JOIN centre_{i} m USING (category, token) GROUP BY ALL)""",
            f"""through_{i} AS (
  SELECT category, token, label, sum(x * s) AS p FROM cells JOIN near_{i} USING (category, item_name) GROUP BY ALL)""",
            f"""product_{i} AS (
  SELECT category, item_name, label, sum(x * p) AS d FROM cells JOIN through_{i} USING (category, token) GROUP BY ALL)""",
            f"square_{i} AS (SELECT category, label, sum(s * s) AS q FROM near_{i} GROUP BY ALL)",
            f"""label_{i} AS (
  SELECT category, item_name, arg_min(label, (round(coalesce(q, 0) - 2 * coalesce(d, 0), 9), label)) AS label
  FROM (SELECT t.category, t.item_name, f.label FROM toks t JOIN firsts f USING (category))
  LEFT JOIN square_{i} USING (category, label) LEFT JOIN product_{i} USING (category, item_name, label) GROUP BY ALL)""",
            f"""centre_{i + 1} AS (
  SELECT category, label, token, sum(x) / any_value(n) AS c FROM cells JOIN label_{i} USING (category, item_name)
  JOIN (SELECT category, label, count(*) AS n FROM label_{i} GROUP BY ALL) USING (category, label) GROUP BY category, label, token
  UNION ALL SELECT * FROM centre_{i} ANTI JOIN label_{i} USING (category, label))""",
        ]
    return views


@query(
    "name_clusters",
    v.with_views(V_PRODUCT, *name_rounds_sql())
    + f"SELECT category, item_name, CAST(label AS INTEGER) AS cluster FROM label_{NAME_ROUNDS}",
)
def q_name_clusters(spark, sf):
    return nm.name_clusters(tokened(spark, sf), NAME_CLUSTERS, max_iter=NAME_ROUNDS)


_REPORT = ", ".join(
    f"max(CASE WHEN cluster = {j} THEN token END) AS clusterName_{j}, max(CASE WHEN cluster = {j} THEN num END) AS clusterNum_{j}"
    for j in range(NAME_CLUSTERS)
)


@query(
    "keyword_report",
    v.with_views(
        V_PRODUCT,
        *name_rounds_sql(),
        f"""named AS (
  SELECT category, label AS cluster, item, unnest({tokens_sql('item_name')}) AS token
  FROM v_product JOIN label_{NAME_ROUNDS} USING (category, item_name) WHERE item > 0)""",
        "summed AS (SELECT category, cluster, token, CAST(sum(item) AS BIGINT) AS num FROM named GROUP BY ALL)",
        """best AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY category, cluster ORDER BY num DESC, token) AS INTEGER) AS rank FROM summed)""",
        "ranks AS (SELECT DISTINCT category, CAST(unnest(range(1, 9)) AS INTEGER) AS rank FROM summed)",
    )
    + f"SELECT category, rank, {_REPORT} FROM ranks LEFT JOIN best USING (category, rank) GROUP BY category, rank",
)
def q_keyword_report(spark, sf):
    names = tokened(spark, sf)
    clusters = nm.name_clusters(names, NAME_CLUSTERS, max_iter=NAME_ROUNDS)
    joined = names.join(clusters, ["category", "item_name"])
    counts = kw.token_count_weighted(joined, "tokens", "item", ["category", "cluster"])
    top = kw.top_n(counts, ["category", "cluster"], 8)
    return kw.clusters_wide(top, ["category"], 4, 8)


CLASSES = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}
PARENTS = {1: (1, "plain"), 2: (2, "sized"), 3: (2, "sized"), 4: (1, "plain"), 5: (2, "sized"), 6: (1, "plain")}


def class_table(spark):
    rows = [(n, c, *PARENTS[n]) for c, n in CLASSES.items()]
    return spark.createDataFrame(rows, "sub_no int, sub_name string, category_no int, category_name string")


CJK = r"\x{4e00}-\x{9fff}"
NAME_TOKENS = f"""list_filter(string_split_regex(lower(regexp_replace(
    regexp_replace(item_name, '[^0-9a-zA-Z{CJK}]+', '', 'g'), '([{CJK}])', ' \\1', 'g')), '\\s+'),
    lambda w: w <> '')"""
_CLASS_CASE = " ".join(f"WHEN '{c}' THEN {n}" for c, n in CLASSES.items())
CLASSIFIED = f"""toks AS (
  SELECT item_name, CASE category {_CLASS_CASE} END AS class_no, {NAME_TOKENS} AS t FROM v_product),
gram AS (
  SELECT item_name, class_no, unnest(t) AS gram FROM toks
  UNION ALL
  SELECT item_name, class_no, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))
  FROM toks WHERE len(t) > 1),
share AS (
  SELECT gram, class_no, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY gram) AS w
  FROM gram GROUP BY gram, class_no),
own AS (
  SELECT item_name, gram, CAST(count(*) AS DOUBLE) / count(DISTINCT copy) AS n FROM (
    SELECT item_name, gram, 1 AS copy FROM (SELECT DISTINCT item_name, t FROM toks) d,
      (SELECT unnest(t) AS gram UNION ALL
       SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) g) x
  GROUP BY item_name, gram),
size AS (SELECT item_name, sum(n) AS n FROM own GROUP BY item_name),
score AS (
  SELECT o.item_name, s.class_no, round(sum(o.n * s.w) / any_value(z.n), 9) AS score
  FROM own o JOIN share s ON o.gram = s.gram JOIN size z ON o.item_name = z.item_name
  GROUP BY o.item_name, s.class_no),
classified AS (
  SELECT item_name, class_no, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_name ORDER BY score DESC, class_no) AS r
    FROM score) t WHERE r = 1
  UNION ALL SELECT DISTINCT item_name, 1, 0.0 FROM toks WHERE len(t) = 0)"""


def class_case():
    case = F.lit(None).cast("int")
    for c, n in CLASSES.items():
        case = F.when(F.col("category") == c, n).otherwise(case)
    return case


def classified(spark, sf):
    rows = products(spark, sf).withColumn("class_no", class_case())
    weights = nm.frequency_weights(rows, "item_name", "class_no", list(CLASSES.values()))
    return nm.classify_names(rows, weights, len(CLASSES), "item_name")


@query(
    "name_class_scores",
    v.with_views(V_PRODUCT, CLASSIFIED)
    + f"SELECT item_name, CAST(class_no AS INTEGER) AS class_no, {sql_round('score', 6)} AS score FROM classified",
)
def q_name_class_scores(spark, sf):
    return classified(spark, sf).withColumn("score", half_up(F.col("score"), 6))


_PARENTS = ", ".join(
    f"({n}, '{c}', {PARENTS[n][0]}, '{PARENTS[n][1]}')" for c, n in CLASSES.items()
)


@query(
    "classify_products",
    v.with_views(
        *KEYWORD_VIEWS,
        CLASSIFIED,
        f"""hierarchy AS (SELECT * FROM (VALUES {_PARENTS})
  h(sub_no, sub_name, category_no, category_name))""",
        """placed AS (
  SELECT item_name, h.* FROM classified c JOIN hierarchy h ON c.class_no = h.sub_no)""",
        """matched AS (
  SELECT p.item_name, name,
         row_number() OVER (PARTITION BY p.item_name ORDER BY num DESC, name) AS rank
  FROM placed p JOIN merged m ON p.sub_name = m.category AND contains(p.item_name, m.name))""",
        "tagged AS (SELECT item_name, "
        + ", ".join(f"max(CASE WHEN rank = {i} THEN name END) AS keyword_{i}" for i in range(1, 6))
        + " FROM matched GROUP BY item_name)",
    )
    + """SELECT v.item_name AS name, category_no, category_name, sub_no, sub_name,
  keyword_1, keyword_2, keyword_3, keyword_4, keyword_5
FROM v_product v LEFT JOIN placed p ON v.item_name = p.item_name
LEFT JOIN tagged t ON v.item_name = t.item_name""",
)
def q_classify_products(spark, sf):
    rows = products(spark, sf).withColumn("class_no", class_case())
    weights = nm.frequency_weights(rows, "item_name", "class_no", list(CLASSES.values()))
    ranked = kw.merge_ranks(wide_top(spark, sf), "category", CLUSTERS)
    return classify_products(
        rows.withColumnRenamed("item_name", "product"), weights, class_table(spark), ranked, len(CLASSES)
    )


@query("name_classifier")
def q_name_classifier(spark, sf):
    rows = products(spark, sf)
    model = nm.train_classifier(rows, "item_name", "category", max_iter=10)
    weights, bias, labels = nm.model_weights(model, spark)
    found = nm.classify_names(rows, weights, len(labels), "item_name", bias)
    return found.withColumn("class_name", F.get(F.lit(labels), F.col("class_no") - 1))


MATCHES = ("sample", "category", "cs")
VOTE_KS = (1, 3, 5, 10)


def _grams_sql(column: str) -> str:
    text = f"lower({clean_sql(column)})"
    return (
        f"CASE WHEN length({text}) >= 2 THEN list_transform(range(1, length({text})), lambda i: substr({text}, i, 2)) "
        f"ELSE [{text}] END"
    )


def _vectors_sql(name: str, source: str, key: str, column: str) -> str:
    """Whole-number weights of the terms of a column, as unit vectors."""
    return f"""{name} AS (
  SELECT {key}, term, CAST(floor(1000000.0::DOUBLE * raw / sqrt(sum(raw * raw) OVER (PARTITION BY {key}))) AS BIGINT) AS w
  FROM (SELECT {key}, term, count(*) * any_value(idf) AS raw
        FROM (SELECT {key}, unnest({_grams_sql(column)}) AS term FROM {source}) t JOIN idf USING (term)
        GROUP BY {key}, term) r)"""


def _match_sql(match: str) -> str:
    votes = ",\n".join(
        f"""vote_{match}_{k} AS (
  SELECT query_id, category AS pred FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, first) AS r FROM (
      SELECT query_id, category, count(*) AS n, min(rank) AS first FROM near_{match} JOIN refs USING (ref_id)
      WHERE rank <= {k} GROUP BY query_id, category) c) o WHERE r = 1)"""
        for k in VOTE_KS
    )
    return f"""{_vectors_sql(f"vec_{match}", "refs", "ref_id", match)},
near_{match} AS (
  SELECT query_id, ref_id, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, ref_id) AS rank FROM (
      SELECT query_id, ref_id, CAST(sum(q.w * r.w) AS BIGINT) // 100000000 AS score
      FROM asked q JOIN vec_{match} r USING (term) GROUP BY query_id, ref_id) d WHERE score > 0) o WHERE rank <= 10),
{votes}"""


@query(
    "reference_classifier_grid",
    v.with_views(
        V_PRODUCT,
        """refs AS (
  SELECT *, row_number() OVER (ORDER BY cs) - 1 AS ref_id FROM (
    SELECT DISTINCT category, sample, category || '-' || sample AS cs FROM (
      SELECT p_type AS category, trim(p_name) AS sample FROM part
      UNION ALL SELECT p_type, p_name || ' ' || p_brand FROM part) s) d)""",
        """names AS (
  SELECT item_name, row_number() OVER (ORDER BY item_name) - 1 AS query_id FROM (SELECT DISTINCT item_name FROM v_product) n)""",
        f"""idf AS (
  SELECT * FROM (
    SELECT term, CAST(floor(ln(((SELECT count(*) FROM refs) + 1)::DOUBLE / (count(*) + 1)) * 1000) AS BIGINT) AS idf
    FROM (SELECT DISTINCT ref_id, unnest({_grams_sql("cs")}) AS term FROM refs) t GROUP BY term) i WHERE idf > 0)""",
        _vectors_sql("asked", "names", "query_id", "item_name"),
        *[_match_sql(m) for m in MATCHES],
    )
    + "SELECT CAST(query_id AS BIGINT) AS query_id, item_name, "
    + ", ".join(f"vote_{m}_{k}.pred AS pred_{k}_{m}" for m in MATCHES for k in VOTE_KS)
    + " FROM names "
    + " ".join(f"LEFT JOIN vote_{m}_{k} USING (query_id)" for m in MATCHES for k in VOTE_KS),
)
def q_reference_classifier_grid(spark, sf):
    """Votes of the nearest samples, matched by sample, category or both."""
    part = v.table(spark, sf, "part").withColumnRenamed("p_type", "category")
    samples = tx.reference_samples(
        tx.sample_lists(part, "category", ["p_name"]),
        part.select("category", F.array(F.concat("p_name", F.lit(" "), "p_brand")).alias("samples")),
    ).dropDuplicates(["cs"])
    refs = materialize(numbered(samples, "cs", "ref_id"))
    names = materialize(numbered(products(spark, sf).select("item_name").distinct(), "item_name", "query_id"))
    idf = materialize(tm.inverse_frequencies(refs, "cs"))
    asked = materialize(tm.term_vectors(names, "query_id", "item_name", idf))
    out = names
    for match in MATCHES:
        near = tm.nearest_terms(asked, tm.term_vectors(refs, "ref_id", match, idf), 10)
        pred = nb.vote(names, near, refs, VOTE_KS)
        out = out.join(
            pred.withColumnsRenamed({c: f"{c}_{match}" for c in pred.columns if c != "query_id"}), "query_id"
        )
    return out


def numbered(df, key: str, name: str):
    """``df`` with the position of its key among the sorted keys."""
    places = dense_index(df.withColumn("all", F.lit(0)), "all", key, name)
    return df.join(places.select(key, F.col(name).cast("long").alias(name)), key)


# --- models ------------------------------------------------------------------------------------


def split_vectors(spark, sf, classes: int | None = None):
    rows = v.table(spark, sf, "embeddings")
    label = F.col("label") % classes if classes else F.col("label")
    rows = tx.hash_split(rows.withColumn("label", label.cast("double")), "vec_id", 0.6)
    rows = materialize(ln.as_vectors(rows, "embedding").drop("embedding"))
    return rows.filter(~F.col("is_test")).drop("is_test"), rows.filter("is_test").drop("is_test")


@query("tree_classifier")
def q_tree_classifier(spark, sf):
    train, test = split_vectors(spark, sf)
    return ln.forest(train, test, trees=10)[0].select("vec_id", "label", "predicted")


@query("tree_importance")
def q_tree_importance(spark, sf):
    train, test = split_vectors(spark, sf)
    return ln.forest(train, test, trees=10)[1]


BOOST = {"rounds": 2, "depth": 2, "bins": 16}


def boosted_sql(rounds: int, depth: int, bins: int) -> str:
    """Views of the boosted trees on three classes, rounds and levels unrolled."""
    gain = "pow(gl / {0}, 2) / (hl / {0} + 1) + pow(ga / {0} - gl / {0}, 2) / (ha / {0} - hl / {0} + 1) - pow(ga / {0}, 2) / (ha / {0} + 1)"
    views = [
        """vectors AS (
  SELECT vec_id, label % 3 AS label, embedding,
         CAST(CAST('0x' || substring(md5(CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 < 0.6 AS is_test
  FROM embeddings)""",
        """cells AS (
  SELECT vec_id, label, is_test, unnest(range(len(embedding))) AS feature,
         CAST(unnest(embedding) AS DOUBLE) AS x FROM vectors)""",
        "bounds AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM cells WHERE NOT is_test GROUP BY feature)",
        f"""binned AS MATERIALIZED (
  SELECT vec_id, label, is_test, feature,
         CASE WHEN hi > lo THEN greatest(0, least({bins - 1}, floor((x - lo) / (hi - lo) * {bins}))) ELSE 0 END::INT AS bin
  FROM cells JOIN bounds USING (feature))""",
        """margin_0 AS (
  SELECT vec_id, label, is_test, c, 0.0::DOUBLE AS m FROM vectors, (SELECT unnest(range(3))::INT AS c))""",
    ]
    for r in range(rounds):
        views.append(
            f"""grad_{r} AS MATERIALIZED (
  SELECT vec_id, c, is_test, floor((p - CASE WHEN c = label THEN 1 ELSE 0 END) * 1048576 + 0.5)::BIGINT AS g,
         floor(p * (1 - p) * 1048576 + 0.5)::BIGINT AS h
  FROM (SELECT *, exp(m - mx) / sum(exp(m - mx)) OVER (PARTITION BY vec_id) AS p
        FROM (SELECT *, max(m) OVER (PARTITION BY vec_id) AS mx FROM margin_{r})))"""
        )
        views.append(f"node_{r}_0 AS (SELECT vec_id, c, 1 AS node FROM grad_{r})")
        for level in range(depth):
            at = f"{r}_{level}"
            views += [
                f"""hist_{at} AS (
  SELECT c, node, feature, bin, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h
  FROM node_{at} JOIN grad_{r} USING (vec_id, c) JOIN binned b USING (vec_id)
  WHERE NOT b.is_test AND node >= {1 << level} GROUP BY ALL)""",
                f"""cum_{at} AS (
  SELECT c, node, feature, bin, sum(g) OVER up AS gl, sum(h) OVER up AS hl, sum(g) OVER al AS ga, sum(h) OVER al AS ha
  FROM hist_{at} WINDOW al AS (PARTITION BY c, node, feature),
       up AS (PARTITION BY c, node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING))""",
                f"""best_{at} AS MATERIALIZED (
  SELECT c, node, feature, bin AS cut, gain FROM (
    SELECT *, row_number() OVER (PARTITION BY c, node ORDER BY gain DESC, feature, bin) AS place FROM (
      SELECT *, {gain.format("1048576.0::DOUBLE")} AS gain FROM cum_{at} WHERE hl > 0 AND hl < ha))
  WHERE place = 1 AND gain > 1e-9)""",
                f"""node_{r}_{level + 1} AS MATERIALIZED (
  SELECT n.vec_id, n.c, CASE WHEN s.node IS NULL THEN n.node ELSE 2 * n.node + (b.bin > s.cut)::INT END AS node
  FROM node_{at} n LEFT JOIN best_{at} s ON n.c = s.c AND n.node = s.node
  LEFT JOIN binned b ON b.vec_id = n.vec_id AND b.feature = s.feature)""",
            ]
        views.append(
            f"""leaf_{r} AS (
  SELECT c, node, -0.3 * (sum(g) / 1048576.0::DOUBLE) / (sum(h) / 1048576.0::DOUBLE + 1) AS worth
  FROM node_{r}_{depth} JOIN grad_{r} USING (vec_id, c) WHERE NOT is_test GROUP BY c, node)"""
        )
        views.append(
            f"""margin_{r + 1} AS MATERIALIZED (
  SELECT vec_id, label, is_test, c, m + worth AS m
  FROM margin_{r} JOIN node_{r}_{depth} USING (vec_id, c) JOIN leaf_{r} USING (c, node))"""
        )
    return v.with_views(*views)


def boosted_model(spark, sf):
    rows = v.table(spark, sf, "embeddings").withColumn("label", F.col("label") % 3)
    rows = tx.hash_split(rows, "vec_id", 0.6)
    return bt.fit(rows.filter(~F.col("is_test")), "embedding", **BOOST), rows.filter("is_test")


@query(
    "boosted_trees",
    boosted_sql(**BOOST)
    + f"""SELECT vec_id, CAST(any_value(label) AS INTEGER) AS label, CAST(arg_max(c, (m, -c)) AS INTEGER) AS predicted
FROM margin_{BOOST["rounds"]} WHERE is_test GROUP BY vec_id""",
)
def q_boosted_trees(spark, sf):
    model, test = boosted_model(spark, sf)
    return model.predict(test, "embedding").select("vec_id", "label", "predicted")


@query(
    "boosted_importance",
    boosted_sql(**BOOST)
    + "SELECT CAST(feature AS INTEGER) AS feature, round(sum(gain), 6) AS gain FROM ("
    + " UNION ALL ".join(
        f"SELECT feature, gain FROM best_{r}_{level}" for r in range(BOOST["rounds"]) for level in range(BOOST["depth"])
    )
    + ") GROUP BY feature",
)
def q_boosted_importance(spark, sf):
    model, _ = boosted_model(spark, sf)
    return model.importance(spark).select("feature", F.round("gain", 6).alias("gain"))


@query("mlp_classifier")
def q_mlp_classifier(spark, sf):
    train, test = split_vectors(spark, sf)
    return ln.perceptron(train, test, [64, 32, 10]).select("vec_id", "label", "predicted")


@query("pca_2d")
def q_pca_2d(spark, sf):
    rows = ln.as_vectors(v.table(spark, sf, "embeddings"), "embedding")
    return ln.project_2d(rows).select("vec_id", "label", "x", "y")
