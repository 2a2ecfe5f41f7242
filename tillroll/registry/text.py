"""Text, keyword and taxonomy queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions import replies, text
from tillroll.functions.numbers import half_up
from tillroll.operators import keywords as kw
from tillroll.operators import profile as pf
from tillroll.operators import taxonomy as tx
from tillroll.operators.ranking import dense_index
from tillroll.registry import views as v
from tillroll.registry.base import query, sql_round
from tillroll.session import materialize

# Product names with CJK characters, brackets, fees and emoji around the words of the part table.
DECOR = ["特大杯熱咖啡☕", "【限定】抑菌潔翼11片", "外送費（雙北）", "-平台費 會員", "冰拿鐵!大杯"]


def products(spark, sf):
    decor = F.get(F.array(*[F.lit(d) for d in DECOR]), F.col("p_size") % 5)
    return v.dealt(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 97 == 0, "!!!")  # a name without tokens
        .when(F.col("p_partkey") % 89 == 0, "a b")  # and one with tokens of one character only
        .otherwise(F.concat("p_name", F.lit(" "), decor))
        .alias("item_name"),
        F.col("p_brand").alias("item_type"),
        F.col("p_type").alias("category"),
        F.col("p_size").alias("item"),
    )


_DECOR_CASE = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DECOR))
V_PRODUCT = f"""v_product AS (
  SELECT p_partkey, CASE WHEN p_partkey % 97 = 0 THEN '!!!' WHEN p_partkey % 89 = 0 THEN 'a b'
           ELSE p_name || ' ' || CASE p_size % 5 {_DECOR_CASE} END END AS item_name,
         p_brand AS item_type, p_type AS category, p_size AS item
  FROM part)"""

KEPT = r"0-9a-zA-Z\x{4e00}-\x{9fff}"
CJK = r"\x{4e00}-\x{9fff}"


def clean_sql(column: str, filler: str = "") -> str:
    return f"regexp_replace({column}, '[^{KEPT}]+', '{filler}', 'g')"


def tokens_sql(column: str) -> str:
    """Words of a cleaned text, every CJK character on its own."""
    spaced = f"regexp_replace({clean_sql(column, ' ')}, '([{CJK}])', ' \\1', 'g')"
    return f"list_filter(string_split_regex(lower({spaced}), '\\s+'), lambda w: w <> '')"


@query(
    "clean_text",
    f"SELECT doc_id, {clean_sql('text')} AS kept, {clean_sql('text', ' ')} AS spaced FROM documents",
)
def q_clean_text(spark, sf):
    docs = v.table(spark, sf, "documents")
    return docs.select(
        "doc_id", text.clean(F.col("text")).alias("kept"), text.clean(F.col("text"), " ").alias("spaced")
    )


@query(
    "name_tokens",
    v.with_views(V_PRODUCT)
    + f"""SELECT p_partkey, array_to_string({tokens_sql("item_name")}, '|') AS tokens,
  CAST(len({tokens_sql("item_name")}) AS INTEGER) AS n_tokens,
  CAST(length(item_name) AS INTEGER) AS n_chars FROM v_product""",
)
def q_name_tokens(spark, sf):
    tokens = text.spaced_tokens(F.col("item_name"))
    return products(spark, sf).select(
        "p_partkey",
        F.array_join(tokens, "|").alias("tokens"),
        F.size(tokens).alias("n_tokens"),
        F.length("item_name").alias("n_chars"),
    )


TOKENS = f"""v_token AS (
  SELECT p_partkey, category, item_type, item, unnest(tokens) AS token
  FROM (SELECT *, {tokens_sql("item_name")} AS tokens FROM v_product) t)"""


def tokened(spark, sf):
    return products(spark, sf).withColumn("tokens", text.spaced_tokens(F.col("item_name")))


@query(
    "char_ngrams",
    v.with_views(
        V_PRODUCT,
        f"""listed AS (SELECT {tokens_sql("item_name")} AS t FROM v_product),
grams AS (
  SELECT unnest(t) AS gram FROM listed
  UNION ALL
  SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM listed
  WHERE len(t) > 1)""",
    )
    + "SELECT gram, count(*) AS num FROM grams GROUP BY gram",
)
def q_char_ngrams(spark, sf):
    grams = text.with_bigrams(F.col("tokens"))
    out = kw.token_count(tokened(spark, sf).withColumn("grams", grams), "grams", [])
    return out.withColumnRenamed("token", "gram")


# Vocabulary: the sorted words of the benchmark texts, numbered from 1; unknown words get 0.
@query(
    "vocabulary_ids",
    v.with_views(
        f"""vocabulary AS (
  SELECT w, row_number() OVER (ORDER BY w) AS id FROM (
    SELECT DISTINCT unnest({tokens_sql("text")}) AS w FROM benchmark) b)""",
        f"""doc_word AS (
  SELECT doc_id, unnest({tokens_sql("text")}) AS w FROM documents)""",
    )
    + """SELECT doc_id, CAST(sum(coalesce(id, 0)) AS BIGINT) AS id_sum,
  count(*) FILTER (WHERE id IS NULL) AS unknown, count(*) AS words
FROM doc_word LEFT JOIN vocabulary USING (w) GROUP BY doc_id""",
)
def q_vocabulary_ids(spark, sf):
    vocabulary = vocabulary_of(v.table(spark, sf, "benchmark"))
    words = v.table(spark, sf, "documents").select(
        "doc_id", F.explode(text.spaced_tokens(F.col("text"))).alias("token")
    )
    counts = words.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))
    found = counts.join(vocabulary, "token", "left")
    token_id = F.coalesce("token_id", F.lit(0))
    return found.groupBy("doc_id").agg(
        F.sum(token_id * F.col("n")).alias("id_sum"),
        F.sum(F.when(F.col("token_id").isNull(), F.col("n")).otherwise(0)).alias("unknown"),
        F.sum("n").alias("words"),
    )


def vocabulary_of(df):
    words = df.select(
        F.lit("all").alias("part"), F.explode(text.spaced_tokens(F.col("text"))).alias("token")
    )
    codes = dense_index(words, "part", "token")
    return codes.select("token", (F.col("code") + 1).cast("long").alias("token_id"))


@query(
    "token_count",
    v.with_views(V_PRODUCT, TOKENS)
    + "SELECT category, token, count(*) AS num FROM v_token GROUP BY category, token",
)
def q_token_count(spark, sf):
    return kw.token_count(tokened(spark, sf), "tokens", ["category"])


@query(
    "token_count_documents",
    f"""SELECT lang, token, count(*) AS num FROM (
  SELECT lang, unnest({tokens_sql("text")}) AS token FROM documents) t GROUP BY lang, token""",
)
def q_token_count_documents(spark, sf):
    docs = v.table(spark, sf, "documents")
    return kw.token_count(
        docs.select("lang", text.spaced_tokens(F.col("text")).alias("tokens")), "tokens", ["lang"]
    )


@query(
    "token_count_weighted",
    v.with_views(V_PRODUCT, TOKENS)
    + """SELECT category, token, CAST(sum(item) AS BIGINT) AS num FROM v_token
WHERE item > 0 GROUP BY category, token""",
)
def q_token_count_weighted(spark, sf):
    return kw.token_count_weighted(tokened(spark, sf), "tokens", "item", ["category"])


CLUSTERS, TOP = 10, 8
_WIDE = ",\n  ".join(
    f"max(CASE WHEN cluster = {j} THEN token END) AS clusterName_{j}, "
    f"CAST(max(CASE WHEN cluster = {j} THEN num END) AS BIGINT) AS clusterNum_{j}"
    for j in range(CLUSTERS)
)
TOP_TOKENS = f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY category, cluster ORDER BY num DESC, token) AS rank
  FROM (SELECT category, item % 10 AS cluster, token, sum(item) AS num FROM v_token
        WHERE item > 0 GROUP BY 1, 2, 3) t),
wide AS (
  SELECT category, rank, {_WIDE}
  FROM ranked WHERE rank <= {TOP} GROUP BY category, rank)"""


def wide_top(spark, sf):
    named = tokened(spark, sf).withColumn("cluster", F.col("item") % 10)
    counts = kw.token_count_weighted(named, "tokens", "item", ["category", "cluster"])
    top = kw.top_n(counts, ["category", "cluster"], TOP)
    return kw.clusters_wide(top, ["category"], CLUSTERS, TOP)


@query(
    "cluster_topn_wide",
    v.with_views(V_PRODUCT, TOKENS, TOP_TOKENS) + "SELECT * FROM wide",
)
def q_cluster_topn_wide(spark, sf):
    return wide_top(spark, sf)


_MERGE = " UNION ALL ".join(
    f"SELECT category, clusterName_{j} AS name, clusterNum_{j} AS num FROM wide"
    for j in range(CLUSTERS)
)
MERGED = f"""merged AS (
  SELECT category, name, CAST(sum(num) AS BIGINT) AS num FROM ({_MERGE}) u
  WHERE name IS NOT NULL GROUP BY category, name)"""
KEYWORD_VIEWS = (V_PRODUCT, TOKENS, TOP_TOKENS, MERGED)


@query("keyword_rank", v.with_views(*KEYWORD_VIEWS) + "SELECT * FROM merged")
def q_keyword_rank(spark, sf):
    return kw.merge_ranks(wide_top(spark, sf), "category", CLUSTERS).orderBy(F.desc("num"), "name")


CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_DICTIONARY = ", ".join(
    f"max(CASE WHEN category = '{c}' THEN name END) AS {c}_key, "
    f"max(CASE WHEN category = '{c}' THEN num END) AS {c}_no"
    for c in CATEGORIES
)


@query(
    "keyword_dictionary",
    v.with_views(*KEYWORD_VIEWS)
    + f"""SELECT CAST(rank AS INTEGER) AS rank, {_DICTIONARY} FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY num DESC, name) AS rank
  FROM merged) t WHERE rank <= 80 GROUP BY rank""",
)
def q_keyword_dictionary(spark, sf):
    ranked = kw.merge_ranks(wide_top(spark, sf), "category", CLUSTERS)
    return kw.dictionary_wide(ranked, "category", CATEGORIES, 80)


@query(
    "keyword_match_top5",
    v.with_views(
        *KEYWORD_VIEWS,
        """matched AS (
  SELECT n.item_name, n.category, name,
         row_number() OVER (PARTITION BY n.item_name, n.category ORDER BY num DESC, name) AS rank
  FROM (SELECT DISTINCT item_name, category FROM v_product) n
  LEFT JOIN merged m ON n.category = m.category AND contains(n.item_name, m.name))""",
    )
    + "SELECT item_name, category, "
    + ", ".join(f"max(CASE WHEN rank = {i} THEN name END) AS keyword_{i}" for i in range(1, 6))
    + " FROM matched GROUP BY item_name, category",
)
def q_keyword_match_top5(spark, sf):
    ranked = kw.merge_ranks(wide_top(spark, sf), "category", CLUSTERS)
    matched = kw.match_keywords(products(spark, sf), ranked, 5, "item_name", "category")
    return kw.fan_out(matched)


@query(
    "class_lookup",
    """SELECT s_suppkey, n_nationkey AS sub_no, n_name AS sub_name, r_regionkey AS major_no,
  r_name AS major_name
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def q_class_lookup(spark, sf):
    hierarchy = v.table(spark, sf, "nation").join(
        v.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return (
        v.table(spark, sf, "supplier")
        .join(hierarchy, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            "s_suppkey",
            F.col("n_nationkey").alias("sub_no"),
            F.col("n_name").alias("sub_name"),
            F.col("r_regionkey").alias("major_no"),
            F.col("r_name").alias("major_name"),
        )
    )


# Two taxonomies: that of the parts, and one made of market segments and nations.
@query(
    "taxonomy_diff",
    """WITH a AS (SELECT p_type AS category, p_brand AS item_type FROM part),
b AS (SELECT CASE WHEN c_nationkey < 12 THEN c_mktsegment ELSE 'PROMO' END AS category,
             'Brand#' || c_nationkey AS item_type FROM customer)
SELECT 'left' AS side, 'category' AS "column", category AS value FROM
  (SELECT category FROM a EXCEPT SELECT category FROM b) t
UNION ALL SELECT 'right', 'category', category FROM
  (SELECT category FROM b EXCEPT SELECT category FROM a) t
UNION ALL SELECT 'left', 'item_type', item_type FROM
  (SELECT item_type FROM a EXCEPT SELECT item_type FROM b) t
UNION ALL SELECT 'right', 'item_type', item_type FROM
  (SELECT item_type FROM b EXCEPT SELECT item_type FROM a) t""",
)
def q_taxonomy_diff(spark, sf):
    left = v.table(spark, sf, "part").select(
        F.col("p_type").alias("category"), F.col("p_brand").alias("item_type")
    )
    segment = F.when(F.col("c_nationkey") < 12, F.col("c_mktsegment")).otherwise("PROMO")
    right = v.table(spark, sf, "customer").select(
        segment.alias("category"),
        F.concat(F.lit("Brand#"), F.col("c_nationkey").cast("string")).alias("item_type"),
    )
    return tx.two_way_difference(left, right, ["category", "item_type"])


@query(
    "item_name_diff",
    f"""WITH d AS (SELECT DISTINCT unnest({tokens_sql("text")}) AS w FROM documents),
c AS (SELECT DISTINCT unnest({tokens_sql("text")}) AS w FROM conversations)
SELECT 'left' AS side, 'item_name' AS "column", w AS value FROM
  (SELECT w FROM d EXCEPT SELECT w FROM c) t
UNION ALL SELECT 'right', 'item_name', w FROM (SELECT w FROM c EXCEPT SELECT w FROM d) t""",
)
def q_item_name_diff(spark, sf):
    words = [
        v.table(spark, sf, t).select(
            F.explode(text.spaced_tokens(F.col("text"))).alias("item_name")
        )
        for t in ("documents", "conversations")
    ]
    return tx.two_way_difference(*words, ["item_name"])


@query(
    "group_count_dedup",
    v.with_views(V_PRODUCT)
    + """SELECT item_type, category, count(item_name) AS item_name,
  count(DISTINCT item_name) AS item_name_dedupe FROM v_product GROUP BY item_type, category""",
)
def q_group_count_dedup(spark, sf):
    return tx.count_dedup(products(spark, sf), ["item_type", "category"])


@query(
    "group_count_first",
    v.with_views(V_PRODUCT)
    + """SELECT c.item_type, c.category, c.n AS item_name, o.n AS item_name_dedupe FROM
  (SELECT item_type, category, count(*) AS n FROM v_product GROUP BY 1, 2) c
LEFT JOIN (SELECT item_type, category, count(*) AS n FROM (
  SELECT item_name, item_type, category,
         row_number() OVER (PARTITION BY item_name ORDER BY item_type, category) AS r
  FROM v_product) f WHERE r = 1 GROUP BY 1, 2) o
ON c.item_type = o.item_type AND c.category = o.category""",
)
def q_group_count_first(spark, sf):
    return tx.count_dedup(products(spark, sf), ["item_type", "category"], global_first=True)


@query(
    "rare_groups",
    v.with_views(V_PRODUCT)
    + """SELECT p_partkey, item_name, item_type, category FROM v_product WHERE item_type IN (
  SELECT item_type FROM v_product GROUP BY item_type, category HAVING count(*) < 10)""",
)
def q_rare_groups(spark, sf):
    rows = tx.rows_of_rare_groups(products(spark, sf), ["item_type", "category"], "item_type")
    return rows.select("p_partkey", "item_name", "item_type", "category")


@query(
    "distinct_cardinality",
    v.with_views(V_PRODUCT)
    + """SELECT count(DISTINCT item_type) AS item_type, count(DISTINCT category) AS category,
  count(DISTINCT item_name) AS item_name FROM v_product""",
)
def q_distinct_cardinality(spark, sf):
    return tx.cardinalities(products(spark, sf), ["item_type", "category", "item_name"])


@query("value_counts", "SELECT source, count(*) AS cnt FROM documents GROUP BY source")
def q_value_counts(spark, sf):
    return pf.value_counts(v.table(spark, sf, "documents"), "source")


@query("distinct_pairs", "SELECT DISTINCT p_brand, p_type FROM part ORDER BY p_brand, p_type")
def q_distinct_pairs(spark, sf):
    part = v.table(spark, sf, "part")
    return part.select("p_brand", "p_type").distinct().orderBy("p_brand", "p_type")


@query(
    "noise_filter",
    v.with_views(V_PRODUCT)
    + """SELECT p_partkey, item_name, category FROM v_product
WHERE NOT contains(item_name, '外送費') AND NOT contains(item_name, '外送員小費')
  AND NOT contains(item_name, '平台費') AND NOT contains(category, '其他')""",
)
def q_noise_filter(spark, sf):
    return tx.without_noise(products(spark, sf)).select("p_partkey", "item_name", "category")


@query(
    "token_predicate",
    v.with_views(V_PRODUCT)
    + f"""SELECT p_partkey, item_name, item_type FROM v_product
WHERE list_contains({tokens_sql("item_name")}, 'ring') AND contains(item_type, '#1')""",
)
def q_token_predicate(spark, sf):
    hit = F.array_contains("tokens", "ring") & F.col("item_type").contains("#1")
    return tokened(spark, sf).filter(hit).select("p_partkey", "item_name", "item_type")


@query(
    "address_filter",
    v.with_views(v.V_STORE)
    + """SELECT store_no, address FROM v_store WHERE regexp_matches(address, '大安區|三地門鄉|東區')""",
)
def q_address_filter(spark, sf):
    districts = "大安區|三地門鄉|東區"
    return v.stores(spark, sf).filter(F.col("address").rlike(districts)).select("store_no", "address")


def histogram_sql(source: str, by: str | None, value: str, bins: int) -> str:
    key = f"{by}, " if by else ""
    on = f"USING ({by})" if by else "ON true"
    group = f"GROUP BY {by}" if by else ""
    bucket = f"""CASE WHEN hi = lo THEN 0
    ELSE least({bins - 1}, CAST(floor((val - lo) / ((hi - lo) / {bins})) AS INTEGER)) END"""
    return f"""SELECT {key}bin, cnt, {sql_round(f"lo + bin * ((hi - lo) / {bins})", 4)} AS bin_lo,
  {sql_round(f"cnt / nullif(total * ((hi - lo) / {bins}), 0)", 4)} AS density
FROM (SELECT {key}lo, hi, total, {bucket} AS bin, count(*) AS cnt
      FROM (SELECT {key}CAST({value} AS DOUBLE) AS val FROM {source}) x
      JOIN (SELECT {key}min(CAST({value} AS DOUBLE)) AS lo, max(CAST({value} AS DOUBLE)) AS hi,
                   count(*) AS total FROM {source} {group}) b {on}
      GROUP BY ALL) h"""


@query("length_histogram", histogram_sql("documents", "lang", "length(text)", 10))
def q_length_histogram(spark, sf):
    docs = v.table(spark, sf, "documents").select("lang", F.length("text").alias("n"))
    return pf.histogram(docs, "n", 10, by="lang")


@query(
    "token_length_histogram",
    v.with_views(V_PRODUCT)
    + histogram_sql("v_product", "item_type", f"len({tokens_sql('item_name')})", 10),
)
def q_token_length_histogram(spark, sf):
    sized = tokened(spark, sf).select("item_type", F.size("tokens").alias("n"))
    return pf.histogram(sized, "n", 10, by="item_type")


@query(
    "token_top200",
    f"""SELECT lang, token, num, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY num DESC, token) AS rank FROM (
    SELECT lang, token, count(*) AS num FROM (
      SELECT lang, unnest({tokens_sql("text")}) AS token FROM documents) t
    GROUP BY lang, token) c) r WHERE rank <= 200""",
)
def q_token_top200(spark, sf):
    return kw.top_n(q_token_count_documents(spark, sf), ["lang"], 200)


@query(
    "pair_cosine",
    v.with_views(
        V_PRODUCT,
        TOKENS,
        """counted AS (
  SELECT category, p_partkey, token, count(*) AS c FROM v_token WHERE length(token) > 1
  GROUP BY ALL),
vector AS (
  SELECT category, item_name, list(token || ':' || c ORDER BY token) AS sig
  FROM counted JOIN v_product USING (category, p_partkey) GROUP BY category, item_name, p_partkey),
rep AS (SELECT category, sig, min(item_name) AS name, count(DISTINCT item_name) AS names
        FROM vector GROUP BY category, sig),
cell AS (SELECT category, name, names, split_part(unnest(sig), ':', 1) AS token,
                CAST(split_part(unnest(sig), ':', 2) AS DOUBLE) AS c FROM rep),
normed AS (SELECT category, name, names, token,
                  c / sqrt(sum(c * c) OVER (PARTITION BY category, name)) AS w FROM cell)""",
    )
    + f"""SELECT category, name_a, name_b, names_a, names_b, {sql_round("cosine", 4)} AS cosine FROM (
  SELECT a.category, a.name AS name_a, b.name AS name_b, a.names AS names_a, b.names AS names_b,
         sum(a.w * b.w) AS cosine
  FROM normed a JOIN normed b ON a.category = b.category AND a.token = b.token AND a.name < b.name
  GROUP BY ALL) t WHERE cosine >= 0.55""",
)
def q_pair_cosine(spark, sf):
    pairs = tx.similar_names(tokened(spark, sf), "category", "item_name", "tokens", 0.55)
    return pairs.withColumn("cosine", half_up(F.col("cosine"), 4))


# Samples of every category: given names of brands below 10, generated ones above.
@query(
    "sample_explode",
    """SELECT category, sample, generated, category || '-' || sample AS cs FROM (
  SELECT p_type AS category, trim(x) AS sample, 0 AS generated
  FROM (SELECT p_type, unnest([p_name, p_brand]) AS x FROM part) g
  UNION ALL SELECT p_type, p_name || '+', 1 FROM part) t""",
)
def q_sample_explode(spark, sf):
    part = v.table(spark, sf, "part").withColumnRenamed("p_type", "category")
    given = tx.sample_lists(part, "category", ["p_name", "p_brand"])
    generated = part.select(
        "category", F.array(F.concat("p_name", F.lit("+"))).alias("samples")
    )
    return tx.reference_samples(given, generated)


def reply_rows(spark, sf, template: str):
    """Assistant turns wrapped into a reply that holds their words as JSON."""
    turns = v.table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    words = text.spaced_tokens(F.col("text"))
    listed = F.concat(F.lit("["), F.array_join(F.transform(words, lambda w: F.concat(F.lit('"'), w, F.lit('"'))), ", "), F.lit("]"))
    return turns.select(
        "conv_id", "turn", words.alias("words"), replies.prompt(template, text=F.col("text"), listed=listed).alias("reply")
    )


REPLY = 'Here you are:\r\n{{"note": "x",\r\n"product_name": {listed}}}\r\nThank you'
V_WORDS = f"""v_words AS (
  SELECT conv_id, turn, {tokens_sql("text")} AS w FROM conversations WHERE role = 'assistant')"""


@query(
    "reply_json",
    v.with_views(V_WORDS)
    + """SELECT conv_id, turn, array_to_string(w, '|') AS products,
  array_to_string(w[3:], '|') AS new_products FROM v_words""",
)
def q_reply_json(spark, sf):
    found = replies.json_list(F.col("reply"), "product_name")
    return reply_rows(spark, sf, REPLY).select(
        "conv_id",
        "turn",
        F.array_join(found, "|").alias("products"),
        F.array_join(replies.without_given(found, F.lit(2)), "|").alias("new_products"),
    )


@query(
    "reply_fallback",
    v.with_views(V_WORDS)
    + """SELECT conv_id, turn, w AS sample FROM (
  SELECT conv_id, turn, unnest(w) AS w FROM v_words) t WHERE NOT contains(w, 'en')""",
)
def q_reply_fallback(spark, sf):
    turns = v.table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    words = text.spaced_tokens(F.col("text"))
    numbered = F.transform(
        words, lambda w, i: F.concat(F.lit('"'), (i + 1).cast("string"), F.lit('": "'), w, F.lit('"'))
    )
    reply = F.concat(F.lit("List: {"), F.array_join(numbered, ", "), F.lit("} and more {}"))
    rows = turns.select("conv_id", "turn", F.explode(replies.numbered_list(reply)).alias("sample"))
    return rows.filter(~F.col("sample").contains("en"))


@query(
    "prompt_column",
    v.with_views(V_PRODUCT)
    + """SELECT p_partkey, 'Name 12 products of ' || CASE WHEN item % 7 = 0 THEN '' ELSE category END || ' such as "' || replace(item_name, '"', '')
  || '", "' || item_type || '", in {"product_name": []}' AS prompt FROM v_product""",
)
def q_prompt_column(spark, sf):
    samples = replies.quoted_list(F.array("item_name", "item_type"))
    template = 'Name {n} products of {category} such as {samples} in {{"product_name": []}}'
    category = F.when(F.col("item") % 7 != 0, F.col("category"))  # some products have none
    filled = replies.prompt(template, n=F.lit(12), category=category, samples=samples)
    return products(spark, sf).select("p_partkey", filled.alias("prompt"))


TAG_REPLY = '{{"tags": {listed}}}'


@query(
    "tag_counter",
    v.with_views(V_WORDS)
    + """SELECT tag, count(*) AS cnt FROM (SELECT unnest(w) AS tag FROM v_words) t
GROUP BY tag HAVING count(*) > 1""",
)
def q_tag_counter(spark, sf):
    found = replies.json_list(F.col("reply"), "tags")
    return tx.tag_counter(reply_rows(spark, sf, TAG_REPLY).select(found.alias("tags")), "tags")


@query(
    "tag_whitelist",
    v.with_views(
        V_WORDS,
        """allowed AS (
  SELECT tag FROM (SELECT unnest(w) AS tag FROM v_words) t GROUP BY tag HAVING count(*) > 3)""",
    )
    + """SELECT w.conv_id, w.turn, coalesce(k.kept_tags, '') AS kept_tags FROM v_words w LEFT JOIN (
  SELECT conv_id, turn, string_agg(tag, '|' ORDER BY pos) AS kept_tags FROM (
    SELECT conv_id, turn, unnest(w) AS tag, unnest(range(len(w))) AS pos FROM v_words) t
  WHERE tag IN (SELECT tag FROM allowed) GROUP BY conv_id, turn) k
ON w.conv_id = k.conv_id AND w.turn = k.turn""",
)
def q_tag_whitelist(spark, sf):
    rows = reply_rows(spark, sf, TAG_REPLY).select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        "conv_id",
        "turn",
        replies.json_list(F.col("reply"), "tags").alias("tags"),
    )
    rows = materialize(rows)
    kept = tx.allowed_tags(rows, "id", "tags", tx.tag_counter(rows, "tags", 3))
    return kept.select("conv_id", "turn", F.array_join("kept_tags", "|").alias("kept_tags"))


@query("sorted_values", "SELECT DISTINCT p_type AS category FROM part ORDER BY category")
def q_sorted_values(spark, sf):
    part = v.table(spark, sf, "part").withColumnRenamed("p_type", "category")
    return part.select("category").distinct().orderBy("category")


@query("fixed_sample", "SELECT doc_id, source FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 100")
def q_fixed_sample(spark, sf):
    return tx.fixed_sample(v.table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 100)


@query(
    "stratified_sample",
    v.with_views(V_PRODUCT)
    + """SELECT category, item_name FROM (
  SELECT category, item_name,
         row_number() OVER (PARTITION BY category ORDER BY md5(item_name), item_name) AS r
  FROM (SELECT DISTINCT category, item_name FROM v_product
        WHERE NOT contains(item_name, '外送費') AND NOT contains(item_name, '平台費')) d) t
WHERE r <= 4""",
)
def q_stratified_sample(spark, sf):
    return tx.stratified_sample(tx.without_noise(products(spark, sf)), "category", "item_name", 4)


@query(
    "hash_split",
    """SELECT doc_id,
  CAST(CAST('0x' || substring(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE)
    / 4294967296.0 < 0.6 AS is_test FROM documents""",
)
def q_hash_split(spark, sf):
    return tx.hash_split(v.table(spark, sf, "documents").select("doc_id"), "doc_id", 0.6)


@query(
    "fraction_sample",
    """SELECT doc_id, lang FROM documents
WHERE CAST(CAST('0x' || substring(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 < 0.1""",
)
def q_fraction_sample(spark, sf):
    return tx.fraction_sample(v.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 0.1)


N_DRAWS = 10_000


@query(
    "replacement_sample",
    f"""WITH numbered AS (
  SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS place, count(*) OVER () AS total FROM documents),
drawn AS (SELECT unnest(range({N_DRAWS})) AS draw)
SELECT draw, doc_id, lang FROM drawn JOIN numbered
ON place = CAST('0x' || substring(md5('draw-' || draw), 1, 8) AS BIGINT) % total""",
)
def q_replacement_sample(spark, sf):
    return tx.draws(v.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", N_DRAWS)


@query(
    "union_dedup",
    """SELECT p_type AS category FROM part GROUP BY p_type HAVING count(*) < 330
UNION SELECT p_type FROM part WHERE p_size > 49""",
)
def q_union_dedup(spark, sf):
    part = v.table(spark, sf, "part").withColumnRenamed("p_type", "category")
    rare = pf.value_counts(part, "category").filter("cnt < 330").select("category")
    return tx.all_of(rare, part.filter("p_size > 49").select("category"))
