"""Round trips through the text formats, over whole tables."""

from __future__ import annotations


from pyspark.sql import functions as F

from tillroll.registry import views as v
from tillroll.registry.base import query
from tillroll.session import run_folder
from tillroll.sources import files, sinks


def folder(spark, name: str) -> str:
    return run_folder(spark, name)


@query("csv_columns", "SELECT c_custkey, c_mktsegment FROM customer")
def q_csv_columns(spark, sf):
    path = folder(spark, "csv")
    sinks.write_csv(v.table(spark, sf, "customer"), path)
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return files.read_csv(spark, path, schema, ["c_custkey", "c_mktsegment"])


@query("csv_indexed", "SELECT p_name, p_brand, p_type FROM part")
def q_csv_indexed(spark, sf):
    path = folder(spark, "indexed")
    sinks.write_csv(v.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type"), path)
    return files.read_indexed_csv(spark, path, "p_name string, p_brand string, p_type string")


# Texts as they are, and for some rows an empty text, null, blanks at the edges, quotes and line ends.
_ODD = ["", None, "  x  ", 'a "quoted", text', '"x', "one\r\ntwo\rthree\n", "back\\slash |,", "\n"]


def odd_texts(df, key: str, column: str):
    odd = F.get(F.array(*map(F.lit, _ODD)), (F.floor(F.col(key) / 7) % len(_ODD)).cast("int"))
    return df.withColumn(column, F.when(F.col(key) % 7 == 0, odd).otherwise(F.col(column)))


def odd_sql(key: str, column: str) -> str:
    def literal(x):
        return "NULL" if x is None else "'" + x.replace("'", "''").replace("\r", "' || chr(13) || '").replace("\n", "' || chr(10) || '") + "'"

    cases = " ".join(f"WHEN {i} THEN {literal(x)}" for i, x in enumerate(_ODD))
    return f"CASE WHEN {key} % 7 = 0 THEN CASE ({key} // 7) % {len(_ODD)} {cases} END ELSE {column} END AS {column}"


@query("csv_pipe", f"SELECT doc_id, lang, source, n_chars, {odd_sql('doc_id', 'text')} FROM documents")
def q_csv_pipe(spark, sf):
    path = folder(spark, "pipe")
    docs = v.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    sinks.write_csv(odd_texts(docs, "doc_id", "text"), path, sep="|")
    schema = "doc_id long, lang string, source string, n_chars long, text string"
    return files.read_csv(spark, path, schema, sep="|", own=True)


@query(
    "lines_no_header",
    """SELECT CASE s_suppkey % 3 WHEN 0 THEN '"' || s_name WHEN 1 THEN s_name || '", "x' ELSE s_name END AS product
FROM supplier""",
)
def q_lines_no_header(spark, sf):
    path = folder(spark, "lines")
    name, kind = F.col("s_name"), F.col("s_suppkey") % 3
    line = F.when(kind == 0, F.concat(F.lit('"'), name)).when(kind == 1, F.concat(name, F.lit('", "x'))).otherwise(name)
    v.table(spark, sf, "supplier").select(line).write.text(path)
    return files.read_lines(spark, path)


@query("word_list", "SELECT split_part(p_name, ' ', 1) AS name FROM part")
def q_word_list(spark, sf):
    path = folder(spark, "words")
    v.table(spark, sf, "part").select("p_name").write.text(path)
    return files.read_first_words(spark, path)


@query("json_lines_to_csv", f"SELECT conv_id, turn, role, {odd_sql('conv_id', 'text')} FROM conversations")
def q_json_lines_to_csv(spark, sf):
    lines, table = folder(spark, "json"), folder(spark, "table")
    odd_texts(v.table(spark, sf, "conversations"), "conv_id", "text").write.json(lines)
    schema = "conv_id long, turn long, role string, text string"
    sinks.write_csv(files.read_json_lines(spark, lines, schema), table)
    return files.read_csv(spark, table, schema, own=True)


@query("glob_category", "SELECT p_partkey, p_name, p_brand AS category FROM part")
def q_glob_category(spark, sf):
    path = folder(spark, "glob")
    sinks.write_csv(v.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), path, ["p_brand"])
    schema = "p_partkey long, p_name string"
    return files.read_glob(spark, f"{path}/*/*.csv", schema, "p_brand=([^/]+)/", partition_folders=True)


@query("partitioned_table", "SELECT user_id, value, event_type FROM events")
def q_partitioned_table(spark, sf):
    path = folder(spark, "table")
    sinks.write_table(v.table(spark, sf, "events").select("user_id", "value", "event_type"), path, ["event_type"])
    return spark.read.parquet(path)


@query(
    "json_records",
    "SELECT page_id, sha256(url) AS hash_id, split_part(url, '/', 4) AS tier1, url, html FROM pages",
)
def q_json_records(spark, sf):
    path = folder(spark, "records")
    tier = F.split_part("url", F.lit("/"), F.lit(4))
    rows = v.table(spark, sf, "pages").select(
        "page_id", F.sha2("url", 256).alias("hash_id"), tier.alias("tier1"), "url", "html"
    )
    sinks.write_records(rows, path)
    return spark.read.schema("page_id long, hash_id string, url string, html string, tier1 string").json(f"{path}/content")
