"""Nearest-reference, vote and evaluation queries over the embeddings table.

Every vector is classified by all other vectors (leave one out).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions.numbers import half_up
from tillroll.operators import evaluate as ev
from tillroll.operators import neighbours as nb
from tillroll.operators import profile as pf
from tillroll.operators import vector_index as vi
from tillroll.registry import views as v
from tillroll.registry.base import query, sql_round
from tillroll.registry.text import histogram_sql

KS = (1, 3, 5, 10)
THRESHOLD = 1.9


def vectors(spark, sf):
    return v.dealt(spark, sf, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"), "label"
    )


def references(spark, sf):
    return vectors(spark, sf).select(
        F.col("query_id").alias("ref_id"), "vector", F.col("label").alias("category")
    )


def knn(spark, sf, k, metric="l2"):
    return nb.nearest(vectors(spark, sf), references(spark, sf), k, metric, skip_same_id=True)


NEAR = """vec AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pair AS (
  SELECT a.vec_id AS query_id, b.vec_id AS ref_id, b.label AS category, a.label AS actual,
         round(pow(list_distance(a.e, b.e), 2), 4) AS score
  FROM vec a JOIN vec b ON a.vec_id <> b.vec_id),
near AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, ref_id) AS rank FROM pair) r
  WHERE rank <= 10)"""


@query(
    "knn_top10",
    f"WITH {NEAR} SELECT query_id, ref_id, score, CAST(rank AS INTEGER) AS rank FROM near",
)
def q_knn_top10(spark, sf):
    return knn(spark, sf, 10)


@query(
    "knn_index_top10",
    f"WITH {NEAR} SELECT query_id, ref_id, score, CAST(rank AS INTEGER) AS rank FROM near",
)
def q_knn_index_top10(spark, sf):
    """The exact neighbours again, from the inverted file with cells ruled out by their bounds."""
    index = vi.build_index(references(spark, sf))
    return vi.search_index(index, vectors(spark, sf), 10, skip_same_id=True)[0]


#: The largest cosine, seen from a centroid, under which the approximate search expects a neighbour.
SPREAD = 0.2


@query("knn_index_recall")
def q_knn_index_recall(spark, sf):
    """Per query: the share of the ten nearest that the approximate search finds, and what either looked at."""
    index = vi.build_index(references(spark, sf))
    exact, looked = vi.search_index(index, vectors(spark, sf), 10, skip_same_id=True)
    near, probed = vi.search_index(index, vectors(spark, sf), 10, skip_same_id=True, spread=SPREAD)
    found = exact.join(near.select("query_id", "ref_id", F.lit(1).alias("hit")), ["query_id", "ref_id"], "left")
    recall = found.groupBy("query_id").agg((F.sum(F.coalesce("hit", F.lit(0))) / F.count(F.lit(1))).alias("recall"))
    return (
        recall.join(looked.withColumnRenamed("candidates", "candidates_exact"), "query_id")
        .join(probed.withColumnRenamed("candidates", "candidates_spread"), "query_id")
        .withColumn("n_refs", F.lit(int(index.count.sum())))
    )


@query(
    "nearest_sample",
    """WITH vec AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
SELECT query_id, ref_id, score, 1 AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, ref_id) AS r FROM (
    SELECT a.vec_id AS query_id, b.vec_id AS ref_id,
           round(list_cosine_similarity(a.e, b.e), 4) AS score
    FROM vec a JOIN vec b ON a.vec_id <> b.vec_id) p) t WHERE r = 1""",
)
def q_nearest_sample(spark, sf):
    return knn(spark, sf, 1, "cosine")


def _vote_sql(k: int) -> str:
    return f"""vote_{k} AS (
  SELECT query_id, category AS pred_{k} FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, first_rank) AS r FROM (
      SELECT query_id, category, count(*) AS n, min(rank) AS first_rank
      FROM near WHERE rank <= {k} AND score < {THRESHOLD} GROUP BY query_id, category) c) t
  WHERE r = 1)"""


VOTES = (
    NEAR
    + ",\n"
    + ",\n".join(_vote_sql(k) for k in KS)
    + f""",
votes AS (
  SELECT vec_id AS query_id, label, {", ".join(f"pred_{k}" for k in KS)} FROM embeddings
  {" ".join(f"LEFT JOIN vote_{k} ON vec_id = vote_{k}.query_id" for k in KS)})"""
)


def votes(spark, sf):
    pred = nb.vote(vectors(spark, sf), knn(spark, sf, 10), references(spark, sf), KS, THRESHOLD)
    return vectors(spark, sf).select("query_id", "label").join(pred, "query_id")


@query("knn_vote", f"WITH {VOTES} SELECT * FROM votes")
def q_knn_vote(spark, sf):
    return votes(spark, sf)


PREDICTIONS = [f"pred_{k}" for k in KS]
_ACCURACY = " UNION ALL ".join(
    f"""SELECT '{p}' AS prediction,
  {sql_round(f"avg(CASE WHEN {p} IS NULL THEN NULL WHEN label = {p} THEN 1.0 ELSE 0.0 END)", 4)} AS accuracy,
  count(*) AS n, count(*) FILTER (WHERE {p} IS NULL) AS missing FROM votes"""
    for p in PREDICTIONS
)


@query("accuracy_grid", f"WITH {VOTES} {_ACCURACY}")
def q_accuracy_grid(spark, sf):
    out = ev.accuracy(votes(spark, sf), "label", PREDICTIONS)
    return out.withColumn("accuracy", half_up(F.col("accuracy"), 4))


@query(
    "coverage",
    f"WITH {VOTES} SELECT "
    + ", ".join(f"count(*) FILTER (WHERE {p} IS NULL) AS {p}" for p in PREDICTIONS)
    + " FROM votes",
)
def q_coverage(spark, sf):
    return pf.null_counts(votes(spark, sf), PREDICTIONS)


CELLS = """cells AS (
  SELECT label AS actual, pred_5 AS predicted, count(*) AS cnt FROM votes
  WHERE pred_5 IS NOT NULL GROUP BY 1, 2),
classes AS (SELECT actual AS class FROM cells UNION SELECT predicted FROM cells),
counts AS (
  SELECT class,
    CAST(coalesce((SELECT sum(cnt) FROM cells WHERE actual = class AND predicted = class), 0) AS BIGINT) AS tp,
    CAST(coalesce((SELECT sum(cnt) FROM cells WHERE actual <> class AND predicted = class), 0) AS BIGINT) AS fp,
    CAST(coalesce((SELECT sum(cnt) FROM cells WHERE actual = class AND predicted <> class), 0) AS BIGINT) AS fn,
    CAST(coalesce((SELECT sum(cnt) FROM cells WHERE actual <> class AND predicted <> class), 0) AS BIGINT) AS tn
  FROM classes)"""


@query("confusion", f"WITH {VOTES},\n{CELLS} SELECT * FROM cells")
def q_confusion(spark, sf):
    return ev.confusion(votes(spark, sf), "label", "pred_5")


@query("confusion_per_label", f"WITH {VOTES},\n{CELLS} SELECT * FROM counts")
def q_confusion_per_label(spark, sf):
    return ev.class_counts(votes(spark, sf), "label", "pred_5")


_REPORT = """report AS (
  SELECT CAST(class AS VARCHAR) AS class, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
         coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
         coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1, tp + fn AS support
  FROM counts)"""
_MEASURES = ("precision", "recall", "f1")


def _report_row(name: str, form: str) -> str:
    cells = ", ".join(f"{sql_round(form.replace('$', m), 4)} AS {m}" for m in _MEASURES)
    support = "support" if name == "class" else "CAST(sum(support) AS BIGINT)"
    label = "class" if name == "class" else f"'{name}'"
    return f"SELECT {label} AS class, {cells}, {support} AS support FROM report"


@query(
    "class_report",
    f"WITH {VOTES},\n{CELLS},\n{_REPORT}\n{_report_row('class', '$')} UNION ALL "
    f"{_report_row('macro avg', 'avg($)')} UNION ALL "
    f"{_report_row('weighted avg', 'sum($ * support) / sum(support)')}",
)
def q_class_report(spark, sf):
    out = ev.class_report(votes(spark, sf), "label", "pred_5")
    return out.withColumns({m: half_up(F.col(m), 4) for m in _MEASURES})


@query(
    "disagreement",
    f"""WITH {VOTES} SELECT count(*) FILTER (WHERE pred_1 IS DISTINCT FROM pred_10) AS differ,
  count(*) AS n FROM votes""",
)
def q_disagreement(spark, sf):
    return ev.disagreement(votes(spark, sf), "pred_1", "pred_10")


@query(
    "rmse",
    f"""WITH {VOTES} SELECT {sql_round("sqrt(avg(pow(label - pred_5, 2)))", 4)} AS rmse FROM votes""",
)
def q_rmse(spark, sf):
    return ev.rmse(votes(spark, sf), "label", "pred_5").select(half_up(F.col("rmse"), 4).alias("rmse"))


# Matched rows: the nearest sample by cosine with its label; the level above is label modulo 3.
MATCHED = """vec AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
matched AS (
  SELECT query_id, actual, category AS predicted, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, ref_id) AS r FROM (
      SELECT a.vec_id AS query_id, b.vec_id AS ref_id, a.label AS actual, b.label AS category,
             round(list_cosine_similarity(a.e, b.e), 4) AS score
      FROM vec a JOIN vec b ON a.vec_id <> b.vec_id) p) t WHERE r = 1)"""


def matched(spark, sf):
    return (
        knn(spark, sf, 1, "cosine")
        .join(references(spark, sf).select("ref_id", F.col("category").alias("predicted")), "ref_id")
        .join(vectors(spark, sf).select("query_id", F.col("label").alias("actual")), "query_id")
        .select("query_id", "actual", "predicted", "score")
    )


@query(
    "match_levels",
    f"""WITH {MATCHED}
SELECT 'item_type' AS level, count(*) FILTER (WHERE actual % 3 = predicted % 3) AS matches,
  count(*) AS n, {sql_round("1.0 / count(DISTINCT actual % 3)", 4)} AS chance FROM matched
UNION ALL
SELECT 'category', count(*) FILTER (WHERE actual = predicted), count(*),
  {sql_round("1.0 / count(DISTINCT actual)", 4)} FROM matched""",
)
def q_match_levels(spark, sf):
    df = matched(spark, sf).withColumns(
        {"type_a": F.col("actual") % 3, "type_p": F.col("predicted") % 3}
    )
    levels = {"item_type": ("type_a", "type_p"), "category": ("actual", "predicted")}
    return ev.level_matches(df, levels).withColumn("chance", half_up(F.col("chance"), 4))


@query(
    "confident_errors",
    f"WITH {MATCHED} SELECT * FROM matched WHERE actual <> predicted AND score > 0.2",
)
def q_confident_errors(spark, sf):
    return ev.confident_errors(matched(spark, sf), "actual", "predicted", "score", 0.2)


@query(
    "score_histogram",
    f"WITH {MATCHED},\njudged AS (SELECT actual = predicted AS correct, score FROM matched) "
    + histogram_sql("judged", "correct", "score", 50),
)
def q_score_histogram(spark, sf):
    judged = matched(spark, sf).withColumn("correct", F.col("actual") == F.col("predicted"))
    return pf.histogram(judged, "score", 50, by="correct")


MEANS = """cell AS (
  SELECT label, unnest(range(1, 65)) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings),
level_2 AS (
  SELECT CAST(label AS VARCHAR) AS label, 'G' || (label % 3) AS parent, list(x ORDER BY pos) AS e
  FROM (SELECT label, pos, avg(x) AS x FROM cell GROUP BY label, pos) m GROUP BY label),
other AS (
  SELECT list(x ORDER BY pos) AS e FROM (SELECT pos, avg(x) AS x FROM cell GROUP BY pos) m),
level_1 AS (
  SELECT 'G' || g AS label, list(x ORDER BY pos) AS e FROM (
    SELECT label % 3 AS g, pos, avg(x) AS x FROM cell GROUP BY 1, 2) m GROUP BY g
  UNION ALL SELECT 'Other', e FROM other UNION ALL SELECT 'G9', e FROM other),
below AS (SELECT parent, label, e FROM level_2
          UNION ALL SELECT l.label, 'Other', o.e FROM level_1 l, other o),
vec AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"""


@query(
    "nearest_label",
    f"""WITH {MEANS} SELECT query_id, best, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, CAST(best AS INTEGER)) AS r
  FROM (SELECT vec_id AS query_id, l.label AS best,
               round(list_cosine_similarity(q.e, l.e), 4) AS score FROM vec q, level_2 l) p) t
WHERE r = 1""",
)
def q_nearest_label(spark, sf):
    means = nb.mean_vectors(vectors(spark, sf), "label")
    labels = means.select(
        F.col("label").cast("long").alias("ref_id"), F.col("label").cast("string").alias("label"), "vector"
    )
    return nb.nearest_label(vectors(spark, sf), labels)


@query(
    "two_stage_label",
    f"""WITH {MEANS},
first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score_1 DESC, label_1) AS r FROM (
      SELECT vec_id AS query_id, q.e, l.label AS label_1,
             round(list_cosine_similarity(q.e, l.e), 4) AS score_1 FROM vec q, level_1 l) p) t
  WHERE r = 1)
SELECT query_id, label_1, score_1, label_2, score_2 FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score_2 DESC, label_2) AS r2 FROM (
    SELECT query_id, label_1, score_1, b.label AS label_2,
           round(list_cosine_similarity(f.e, b.e), 4) AS score_2
    FROM first f JOIN below b ON f.label_1 = b.parent) p) t WHERE r2 = 1""",
)
def q_two_stage_label(spark, sf):
    data = vectors(spark, sf)
    group = F.concat(F.lit("G"), (F.col("label") % 3).cast("string"))
    other = nb.mean_vectors(data.withColumn("all", F.lit("Other")), "all").select(
        F.col("all").alias("label"), "vector"
    )
    level_1 = nb.mean_vectors(data.withColumn("g", group), "g").select(F.col("g").alias("label"), "vector")
    # A second label with the vector of the rest label: every query that is nearest to it is a tie.
    level_1 = level_1.unionByName(other).unionByName(other.withColumn("label", F.lit("G9")))
    level_2 = nb.mean_vectors(data, "label").select(
        group.alias("parent"), F.col("label").cast("string").alias("label"), "vector"
    )
    rest = level_1.select(F.col("label").alias("parent")).crossJoin(F.broadcast(other))
    level_2 = level_2.unionByName(rest.select("parent", "label", "vector"))
    return nb.two_stage_label(data.select("query_id", "vector"), level_1, level_2)
