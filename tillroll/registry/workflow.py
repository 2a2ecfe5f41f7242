"""Configuration, sinks and small steps of the workflow, over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions import places, text
from tillroll.operators import keywords as kw
from tillroll.operators import pages as pg
from tillroll.operators import prepare as pr
from tillroll.operators import segmenter as sg
from tillroll.plans.crawl import store_products
from tillroll.registry import views as v
from tillroll.registry.base import query
from tillroll.registry.crawl import HOST, pages_a
from tillroll.registry.relational import SCOPE_VIEWS, SUMS, VALUE, feature_views, features, q_category_value
from tillroll.registry.text import CJK, KEPT
from tillroll.session import run_folder
from tillroll.sources import files, sinks


def one_json(df, key: str, value, folder: str) -> None:
    """All rows as one JSON object, key to value, in one file; the keys are few."""
    entries = F.map_from_entries(F.collect_list(F.struct(key, value)))
    df.agg(F.to_json(entries).alias("value")).coalesce(1).write.text(folder)


@query(
    "config_rows",
    """SELECT DISTINCT p_type AS category, p_brand AS key,
  CASE WHEN ends_with(p_brand, '1') THEN 'object' ELSE 'values' END AS format FROM part""",
)
def q_config_rows(spark, sf):
    path = run_folder(spark, "config")
    keys = v.table(spark, sf, "part").groupBy("p_type").agg(F.sort_array(F.collect_set("p_brand")).alias("key"))
    kind = F.transform("key", lambda k: F.when(k.endswith("1"), "object").otherwise("values"))
    one_json(keys, "p_type", F.struct("key", kind.alias("format")), path)
    return files.read_catalogue(spark, path)


@query("sample_map", "SELECT DISTINCT p_type AS category, p_name AS sample FROM part")
def q_sample_map(spark, sf):
    path = run_folder(spark, "samples")
    sinks.write_sample_map(v.table(spark, sf, "part"), path, "p_type", "p_name")
    return files.read_sample_map(spark, path, lines=True).select("category", F.explode("samples").alias("sample"))


# A table of planned runs, one per part; some are wrong.
_PLANNED = """planned AS (
  SELECT p_partkey, ['KMeans', 'KPrototypes', 'KMedoids', 'KModes', 'WKMeans', 'Ward'][CAST(p_partkey % 6 + 1 AS INTEGER)] AS method,
         CASE WHEN p_size % 3 > 0 THEN p_size END AS k, p_size % 3 = 0 OR p_size % 10 = 0 AS auto,
         ['elbow', 'calinski-harabasz', 'davies-bouldin', 'silhouette', 'bic'][CAST(p_size % 5 + 1 AS INTEGER)] AS score,
         ['average', 'median', 'mode', 'max'][CAST(p_size % 4 + 1 AS INTEGER)] AS rfm_split,
         CASE p_partkey % 4 WHEN 0 THEN 'qty' WHEN 1 THEN 'mid' END AS weight, CAST(p_size % 7 AS INTEGER) AS restarts,
         CASE p_size % 4 WHEN 0 THEN 'hash' WHEN 1 THEN 'first' WHEN 2 THEN 'random' END AS init
  FROM part)"""


@query(
    "option_checks",
    f"""WITH {_PLANNED}
SELECT p_partkey, CASE
  WHEN method NOT IN ('KMeans', 'KPrototypes', 'KMedoids', 'KModes', 'WKMeans') THEN 'method'
  WHEN method = 'WKMeans' AND weight IS NULL THEN 'weight' WHEN weight IN ('mid', 'pma_no_fin') THEN 'weight'
  WHEN auto = (k IS NOT NULL) THEN 'k' WHEN score = 'bic' THEN 'score'
  WHEN restarts < 1 OR init = 'random' THEN 'start' WHEN rfm_split = 'max' THEN 'rfm_split' END AS problem
FROM planned""",
)
def q_option_checks(spark, sf):
    part = v.table(spark, sf, "part")
    pick = lambda values, at: F.get(F.array(*[F.lit(x) for x in values]), at.cast("int"))
    size = F.col("p_size")
    planned = part.select(
        "p_partkey",
        pick([*pr.METHODS, "Ward"], F.col("p_partkey") % 6).alias("method"),
        F.when(size % 3 > 0, size).alias("k"),
        ((size % 3 == 0) | (size % 10 == 0)).alias("auto"),
        pick([*pr.SCORES, "bic"], size % 5).alias("score"),
        pick([*pr.SPLITS, "max"], size % 4).alias("rfm_split"),
        pick(["qty", "mid"], F.col("p_partkey") % 4).alias("weight"),
        (size % 7).alias("restarts"),
        pick(["hash", "first", "random"], size % 4).alias("init"),
    )
    return planned.select("p_partkey", pr.option_problem().alias("problem"))


@query("group_folders", "SELECT vec_id, label, count(*) OVER (PARTITION BY label) AS cnt FROM embeddings")
def q_group_folders(spark, sf):
    path = run_folder(spark, "groups")
    detail = v.table(spark, sf, "embeddings").select("vec_id", "label")
    sinks.write_groups(detail, detail.groupBy("label").agg(F.count(F.lit(1)).alias("cnt")), path)
    rows = files.read_csv(spark, f"{path}/detail", "vec_id long, label long", own=True)
    return rows.join(files.read_csv(spark, f"{path}/describe", "cnt long, label long", own=True), "label")


@query(
    "category_cluster_folders",
    "SELECT p_partkey, p_name, p_type || '/' || p_brand AS category, p_size % 4 AS cluster FROM part",
)
def q_category_cluster_folders(spark, sf):
    """Names with slashes and clusters as folders, and back."""
    path = run_folder(spark, "folders")
    category = F.concat("p_type", F.lit("/"), "p_brand").alias("category")
    rows = v.table(spark, sf, "part").select("p_partkey", "p_name", category, (F.col("p_size") % 4).alias("cluster"))
    sinks.write_csv(rows, path, ["category", "cluster"])
    return files.read_csv(spark, path, "p_partkey long, p_name string, category string, cluster int", own=True)


@query(
    "keyword_json_map",
    """SELECT category, name, num FROM (
  SELECT p_type AS category, p_brand AS name, count(*) AS num FROM part GROUP BY p_type, p_brand)
QUALIFY row_number() OVER (PARTITION BY category ORDER BY num DESC, name) <= 5""",
)
def q_keyword_json_map(spark, sf):
    path = run_folder(spark, "keywords")
    counts = v.table(spark, sf, "part").groupBy(F.col("p_type").alias("category"), F.col("p_brand").alias("name"))
    sinks.write_keyword_map(counts.agg(F.count(F.lit(1)).alias("num")), path, n=5)
    back = files.read_json_lines(spark, path, "category string, name array<string>, num array<long>")
    return back.select("category", F.explode(F.arrays_zip("name", "num")).alias("t")).select("category", "t.*")


RUNS = ("20240101_000000", "20240102_000000")


@query(
    "archived_runs",
    f"""SELECT c_custkey, c_name, run_ts FROM customer, (VALUES {", ".join(f"('{r}')" for r in RUNS)}) runs(run_ts)
UNION ALL SELECT c_custkey, c_name, 'current' FROM customer WHERE c_custkey % 2 = 0""",
)
def q_archived_runs(spark, sf):
    """Two runs that keep each other, and one place that the last run overwrites."""
    base, current = run_folder(spark, "archive"), run_folder(spark, "current")
    rows = v.table(spark, sf, "customer").select("c_custkey", "c_name")
    for run in RUNS:
        sinks.write_table(rows, sinks.run_path(base, False, run))
        last = rows if run == RUNS[0] else rows.filter("c_custkey % 2 = 0")
        sinks.write_table(last, sinks.run_path(current, True, run))
    kept = spark.read.schema("c_custkey long, c_name string, run_ts string").parquet(base)
    return kept.unionByName(spark.read.parquet(current).withColumn("run_ts", F.lit("current")))


@query(
    "one_category",
    v.with_views(*SCOPE_VIEWS, SUMS, VALUE) + "SELECT mid, pma_no_fin, qty, cv FROM member_value WHERE pma_no_fin = 'LARGE'",
)
def q_one_category(spark, sf):
    wanted = ["mid", "pma_no_fin", "qty", "cv"]
    return pr.one_category(pr.require_columns(q_category_value(spark, sf), wanted).select(*wanted), "LARGE")


_RAW = ", ".join(["mid", "pma_no_fin", *pr.RFM_COLUMNS.values()])


@query("clustering_columns", v.with_views(*feature_views()) + f"SELECT * EXCLUDE ({_RAW}) FROM features")
def q_clustering_columns(spark, sf):
    """The feature table as it enters the clustering."""
    table = features(spark, sf)
    return table.select(*pr.clustering_columns(table, True))


_TEXTS = ("weekday", "weekend", "active_city", "active_region", "home_city", "sex")


@query(
    "categorical_columns",
    v.with_views(*feature_views())
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, count(DISTINCT {c}) AS n_values, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM features"
        for c in _TEXTS
    ),
)
def q_categorical_columns(spark, sf):
    """The text columns found by position among the clustering columns, with what they hold."""
    table = features(spark, sf)
    columns = pr.clustering_columns(table, True)
    found = [columns[i] for i in pr.categorical_positions(columns, pr.text_columns(table))]
    sides = [
        F.struct(
            F.lit(c).alias("name"), F.count_distinct(c).alias("n_values"), F.count_if(F.col(c).isNull()).alias("missing")
        ).alias(f"s{i}")
        for i, c in enumerate(found)
    ]
    one = table.agg(*sides)
    return one.select(F.explode(F.array(*[f"s{i}" for i in range(len(found))])).alias("s")).select("s.*")


@query(
    "basic_words",
    r"""WITH flat AS (
  SELECT doc_id, regexp_replace(replace(lower(text), '"', ''), '<br />|[;:]', ' ', 'g') AS t FROM documents),
apart AS (
  SELECT doc_id, replace(regexp_replace(t, '([.,()!?])', ' \1 ', 'g'), chr(39), ' ' || chr(39) || '  ') AS t FROM flat)
SELECT doc_id, array_to_string(list_filter(string_split_regex(t, '\s+'), lambda w: w <> ''), ' ') AS words FROM apart""",
)
def q_basic_words(spark, sf):
    docs = v.table(spark, sf, "documents")
    return docs.select("doc_id", F.array_join(text.words(F.col("text")), " ").alias("words"))


_ENTRIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "ECONOMYLARGE"]


@query(
    "dictionary_tokens",
    f"""SELECT p_partkey, array_to_string(regexp_extract_all(
  regexp_replace(p_type || p_type || '熱咖啡' || p_name || 'LARGE' || p_size, '[^{KEPT}]+', ' ', 'g'),
  '({"|".join(sorted(_ENTRIES, key=lambda w: (-len(w), w)))}|[0-9a-zA-Z]+|[{CJK}])'), '|') AS tokens FROM part""",
)
def q_dictionary_tokens(spark, sf):
    """The classes as dictionary, in names without blanks between the words."""
    part = v.table(spark, sf, "part")
    name = F.concat("p_type", "p_type", F.lit("熱咖啡"), "p_name", F.lit("LARGE"), F.col("p_size").cast("string"))
    return part.select("p_partkey", F.array_join(text.dictionary_tokens(name, _ENTRIES), "|").alias("tokens"))


# Names without blanks, cut by the words of all names and their halves; sizes are no words.
@query(
    "probable_tokens",
    r"""WITH RECURSIVE word AS (SELECT unnest(string_split(p_name, ' ')) AS w FROM part),
piece AS (
  SELECT w AS word FROM word UNION ALL SELECT substr(w, 1, length(w) // 2) FROM word
  UNION ALL SELECT substr(w, length(w) // 2 + 1) FROM word),
counted AS (SELECT word, count(*) AS n FROM piece WHERE word <> '' GROUP BY word),
weight AS (
  SELECT word, CAST(floor(ln(n / (SELECT CAST(sum(n) AS DOUBLE) FROM counted)) * 1000) AS BIGINT) AS weight FROM counted),
joined AS (SELECT DISTINCT replace(p_name, ' ', '') || p_size AS name FROM part),
path AS (
  SELECT name, 0 AS pos, CAST(0 AS BIGINT) AS score, CAST([] AS BIGINT[]) AS steps, CAST([] AS VARCHAR[]) AS tokens FROM joined
  UNION ALL
  SELECT p.name, CAST(pos + length(c.word) AS INTEGER), score + c.weight, list_append(steps, length(c.word)), list_append(tokens, c.word)
  FROM path p, LATERAL (
    SELECT word, weight FROM weight WHERE starts_with(substr(p.name, pos + 1), word)
    UNION ALL SELECT substr(p.name, pos + 1), (SELECT min(weight) - 1000 FROM weight)) c
  WHERE pos < length(p.name)),
best AS (
  SELECT name, tokens FROM path WHERE pos = length(name)
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, steps DESC) = 1)
SELECT p_partkey, array_to_string(tokens, '|') AS tokens
FROM part JOIN best ON best.name = replace(p_name, ' ', '') || p_size""",
)
def q_probable_tokens(spark, sf):
    part = v.table(spark, sf, "part")
    word = part.select(F.explode(F.split("p_name", " ")).alias("w"))
    half = F.floor(F.length("w") / 2).cast("int")
    pieces = F.array(F.col("w"), F.substring("w", F.lit(1), half), F.substring("w", half + 1, F.length("w")))
    dictionary = word.select(F.explode(pieces).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    names = part.select("p_partkey", F.concat(F.replace("p_name", F.lit(" "), F.lit("")), F.col("p_size").cast("string")).alias("name"))
    return sg.segment(names, "name", dictionary).select("p_partkey", F.array_join("tokens", "|").alias("tokens"))


@query("path_names", "SELECT p_partkey, replace(p_type || '/' || p_name, '/', '_') AS name FROM part")
def q_path_names(spark, sf):
    name = F.concat("p_type", F.lit("/"), "p_name")
    return v.table(spark, sf, "part").select("p_partkey", text.path_safe(name).alias("name"))


@query(
    "page_coordinates",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey / 8.0 - 90 AS DOUBLE) END AS longitude,
  CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey * 0.25 AS DOUBLE) END AS latitude FROM customer""",
)
def q_page_coordinates(spark, sf):
    """Saved map pages; every fifth has no state."""
    c = F.col
    state = F.concat(
        F.lit("<p>[[[1,2,3]]]</p>;window.APP_INITIALIZATION_STATE=[[[9.5, "),
        (c("c_custkey") / 8.0 - 90).cast("decimal(20,4)").cast("string"),
        F.lit(" ,"),
        (c("c_nationkey") * 0.25).cast("decimal(20,4)").cast("string"),
        F.lit("],[0,0]]]"),
    )
    page = F.when(c("c_custkey") % 5 == 0, "<p>[[[1,2,3]]]</p>").otherwise(state)
    return v.table(spark, sf, "customer").select("c_custkey", places.coordinates(page).alias("at")).select("c_custkey", "at.*")


@query(
    "page_bar_fanout",
    """SELECT p_partkey AS page_id, CAST(unnest(range(1, CASE WHEN p_size % 4 = 0 THEN 1 ELSE p_size END + 1)) AS INTEGER) AS page_no
FROM part""",
)
def q_page_bar_fanout(spark, sf):
    """List pages with a page bar such as 1 ... /12; every fourth has none."""
    bar = F.concat(F.lit('<div class="pageArea"><span>1</span><span>/'), F.col("p_size").cast("string"), F.lit("</span></div>"))
    body = F.concat(F.lit("<html><body><span>/99</span>"), F.when(F.col("p_size") % 4 == 0, "").otherwise(bar), F.lit("</body></html>"))
    lists = v.dealt(spark, sf, "part").select(F.col("p_partkey").alias("page_id"), body.alias("html"))
    read = pg.parsed(lists, {"bar": (".pageArea", "span")}).select("page_id", pg.page_count(F.col("el.bar")).alias("n"))
    return pg.fan_out_pages(read, F.col("n")).select("page_id", "page_no")


_WIDE = ["ECONOMY", "LARGE", "PROMO"]


@query(
    "dictionary_long",
    f"""SELECT p_type AS category, p_brand AS name, count(*) AS num FROM part
WHERE p_type IN ({", ".join(map(repr, _WIDE))}) GROUP BY ALL""",
)
def q_dictionary_long(spark, sf):
    """A wide keyword dictionary, one pair of columns per class, as rows."""
    counts = v.table(spark, sf, "part").groupBy("p_type", "p_brand").agg(F.count(F.lit(1)).alias("n"))
    columns = []
    for c in _WIDE:
        own = F.col("p_type") == c
        columns += [F.when(own, F.col("p_brand")).alias(f"{c}_key"), F.when(own, F.col("n")).alias(f"{c}_no")]
    return kw.dictionary_long(counts.select(*columns), _WIDE)


def repeated_pages(spark, sf):
    """Every product page twice, the second time under a later number."""
    twice = pages_a(spark, sf).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return twice.select((F.col("page_id") + F.col("copy") * 1_000_000).alias("page_id"), "url", "html")


@query(
    "store_products",
    f"""SELECT p_partkey AS page_id, sha256('{HOST}/goods/' || p_partkey) AS hash_id, p_type AS tier1, p_brand AS tier2,
  p_brand || ' ' || p_name AS item_name FROM part""",
)
def q_store_products(spark, sf):
    path = run_folder(spark, "products")
    store_products(repeated_pages(spark, sf), path, F.lit(v.TODAY))
    schema = "page_id long, hash_id string, tier1 string, tier2 string, item_name string"
    return spark.read.schema(schema).json(f"{path}/content")


@query(
    "review_pages",
    f"SELECT sha256('{HOST}/goods/' || p_partkey) AS hash_id, 4 AS n_cards, '5|3|5|3' AS scores FROM part",
)
def q_review_pages(spark, sf):
    """The review cards of both pages of a product in one list."""
    joined = pg.cards_of_products(pg.product_records_a(repeated_pages(spark, sf), F.lit(v.TODAY)))
    scores = F.array_join(F.transform("cards", lambda c: c["review_card_score"]), "|")
    return joined.select("hash_id", F.size("cards").alias("n_cards"), scores.alias("scores"))
