"""Queries of the numbered operators, with SQL where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    centroids,
    copies,
    decontaminate,
    language,
    licenses,
    mixing,
    neighbours,
    pages,
    personal,
    quotes,
    secrets,
    simhash,
    spelling,
    weighted_sampling,
)
from tillroll.llm.common import blank_words_count, table
from tillroll.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


OP2_SQL = f"""
WITH docs AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS w FROM benchmark),
cut AS (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0),
bench AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM cut),
sizes AS (SELECT DISTINCT n FROM bench),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n),
grams AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM places),
found AS (SELECT doc_id, grams.n, i, item FROM grams JOIN bench ON grams.n = bench.n AND grams.g = bench.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@_query("op2_decontamination", OP2_SQL)
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def sized(docs: DataFrame) -> DataFrame:
    """``source``, ``digest`` and ``size`` beside the columns of ``docs``; what the mix works on."""
    return docs.withColumns(
        {"digest": mixing.seeded_hex(F.col("doc_id"), seed=mixing.SEED), "size": blank_words_count(F.col("text"))}
    )


_SQL_HEX8 = "CAST(('0x' || substr({0}, 1, 8)) AS BIGINT)"
OP10_SQL = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS source_rows,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS code
  FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(code % 3) + 1] AS weight FROM per_source),
ranked AS (
  SELECT *, sum(2 * source_size) OVER up - 2 * source_size AS held,
         sum(weight) OVER () - (sum(weight) OVER up - weight) AS free,
         1.5::DOUBLE * (SELECT sum(source_size) FROM weighed) AS words
  FROM weighed
  WINDOW up AS (ORDER BY 2.0 * source_size / weight, code ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT max((words - held)::DOUBLE / free) AS level FROM ranked
  WHERE weight * ((words - held)::DOUBLE / free) <= 2 * source_size),
targets AS (
  SELECT weighed.*, least(CAST(2 * source_size AS DOUBLE), weight * coalesce(level, 0)) AS target,
         2 * CAST(ceil(source_size / 32) AS BIGINT) AS most
  FROM weighed, level),
seats AS (SELECT CAST(floor(sum(target) / 32 + 0.5) AS BIGINT) AS seats FROM targets),
quotients AS (SELECT code, unnest(range(most)) AS seat, target FROM targets WHERE target > 0),
dealt AS (
  SELECT code, seat, row_number() OVER (ORDER BY target / (2 * seat + 1) DESC, code, seat) AS r FROM quotients),
source_quota AS (SELECT code, count(*) AS seats FROM dealt, seats WHERE r <= seats.seats GROUP BY code),
sharded AS (
  SELECT s.*, t.code, t.source_size, t.target,
         {_SQL_HEX8.format("s.digest")} % CAST(ceil(t.source_rows / 4096) AS BIGINT) AS shard
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
shards AS (
  SELECT code, shard, sum(size) AS shard_size, CAST(ceil(sum(size) / 32) AS BIGINT) AS blocks
  FROM sharded GROUP BY code, shard),
shard_quotients AS (
  SELECT code, shard, shard_size, unnest(range(2 * blocks)) AS seat FROM shards WHERE shard_size > 0),
shard_dealt AS (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY shard_size / (2 * seat + 1) DESC, shard, seat) AS r
  FROM shard_quotients),
quotas AS (
  SELECT d.code, shard, count(*) AS quota FROM shard_dealt d JOIN source_quota q USING (code)
  WHERE r <= seats GROUP BY d.code, shard),
placed AS (
  SELECT h.*, blocks, coalesce(quota, 0) AS quota,
         sum(size) OVER (PARTITION BY h.code, h.shard ORDER BY digest, doc_id, size ROWS UNBOUNDED PRECEDING) AS stop,
         {_SQL_HEX8.format("md5('mix-1|' || coalesce(h.source, 'null') || '|' || h.shard)")} % greatest(blocks, 1) AS shift
  FROM sharded h JOIN shards USING (code, shard) LEFT JOIN quotas USING (code, shard)),
cut AS (
  SELECT *, unnest([stop, stop - size]) AS pos, unnest([1, -1]) AS sign FROM placed WHERE size > 0),
passed AS (
  SELECT *, pos // 32 AS k, ((pos // 32) * quota + shift) // blocks AS lo,
         ((pos // 32 + 1) * quota + shift) // blocks AS hi FROM cut),
taken AS (
  SELECT doc_id, source, digest, size, stop, sum(sign * (32 * lo + (pos - 32 * k) * (hi - lo))) AS taken
  FROM passed GROUP BY ALL)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM placed p LEFT JOIN taken t ON p.doc_id = t.doc_id AND p.stop = t.stop AND p.size = t.size
"""


@_query("op10_source_mix", OP10_SQL)
def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = materialize(sized(table(spark, folder, "documents")).select("doc_id", "source", "digest", "size"))
    mixed = mixing.mix(docs, mixing.shard_quotas(docs), ["doc_id", "size"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@_query("op3_simhash")
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_copies(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@_query("op4_language")
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.predict(docs, language.fit_not_held_out(docs))


def _edited_rows():
    """Fingerprints of texts, of edited texts and of the next texts; one function per task."""
    sampler = weighted_sampling.Sampler()

    def run(ids: list, texts: list[str], nexts: list[str]) -> pa.RecordBatch:
        edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, nexts)]
        other = [i for i, n in enumerate(nexts) if i + 1 == len(texts) or n is not texts[i + 1]]
        found = sampler.signatures([weighted_sampling.terms(t) for t in [*texts, *edited, *(nexts[i] for i in other)]])
        own, cut, more = found[: len(texts)], found[len(texts) : 2 * len(texts)], found[2 * len(texts) :]
        after = own[[min(i + 1, len(texts) - 1) for i in range(len(texts))]]
        after[other] = more
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                "fingerprint": [weighted_sampling.hex_digits(x) for x in own],
                "edited_fingerprint": [weighted_sampling.hex_digits(x) for x in cut],
                "near_edited": (own == cut).mean(1),
                "near_next": (own == after).mean(1),
            }
        )

    return run


@_query("op5_weighted_fingerprint")
def op5_weighted_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.with_next(
        table(spark, folder, "documents"),
        "doc_id",
        "text",
        _edited_rows,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


@_query("op6_license_scan")
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents")).drop("spans")


@_query("op1_consensus_text")
def op1_consensus_text(spark: SparkSession, folder: str) -> DataFrame:
    found = pages.main_texts(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@_query("op9_personal_data")
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.per_document(table(spark, folder, "documents"))
    return found.select(
        "doc_id", *[f"n_{k}" for k in personal.KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


_SQL_MARKS = r"'^[ \t]*(?:>[ \t]?)+'"
_SQL_LEVEL = f"len(regexp_replace(regexp_extract({{0}}, {_SQL_MARKS}), '[^>]', '', 'g'))"
OP7_SQL = rf"""
WITH RECURSIVE split AS (
  SELECT conv_id, turn, role, text, string_split_regex(text, '\r\n|\r|\n') AS l FROM conversations),
numbered AS (
  SELECT conv_id, turn, text, unnest(l) AS line, unnest(range(len(l))) AS pos
  FROM (SELECT DISTINCT conv_id, turn, text, l FROM split WHERE turn IS NOT NULL AND text IS NOT NULL)),
leveled AS (
  SELECT conv_id, turn, text, pos, {_SQL_LEVEL.format("line")} AS level,
         regexp_replace(line, {_SQL_MARKS}, '') AS body FROM numbered),
marked AS (
  SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER w THEN 1 ELSE 0 END AS fresh
  FROM leveled WINDOW w AS (PARTITION BY conv_id, turn, text ORDER BY pos)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY conv_id, turn, text ORDER BY pos) AS run FROM marked),
bodies AS (
  SELECT conv_id, turn, level, body FROM runs UNION ALL
  SELECT conv_id, turn, level, string_agg(body, ' ' ORDER BY pos) FROM runs GROUP BY conv_id, turn, text, run, level),
units AS (
  SELECT DISTINCT conv_id, turn, level, trim(regexp_replace(lower(body), '\s+', ' ', 'g')) AS unit
  FROM bodies WHERE trim(regexp_replace(lower(body), '\s+', ' ', 'g')) <> ''),
origins AS (SELECT conv_id, unit, min(turn) AS origin FROM units WHERE level = 0 GROUP BY ALL),
votes AS (
  SELECT u.conv_id, u.turn, u.level, origin, sum(len(u.unit)) AS chars
  FROM units u JOIN origins o ON u.conv_id IS NOT DISTINCT FROM o.conv_id AND u.unit = o.unit
  WHERE u.level > 0 AND origin < u.turn GROUP BY ALL),
replies AS (
  SELECT conv_id, turn, origin AS parent FROM votes
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, chars DESC, origin DESC) = 1),
walk AS (
  SELECT conv_id, turn, parent, parent AS root, 1 AS depth FROM replies UNION ALL
  SELECT w.conv_id, w.turn, w.parent, r.parent, depth + 1
  FROM walk w JOIN replies r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND w.root = r.turn),
ways AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY depth DESC) = 1)
SELECT s.conv_id, s.turn, s.role,
       regexp_replace(array_to_string(list_filter(l, lambda x: {_SQL_LEVEL.format("x")} = 0), chr(10)), '^\s+|\s+$', '', 'g') AS text,
       CAST(coalesce(list_max(list_transform(l, lambda x: {_SQL_LEVEL.format("x")})), 0) AS INT) AS quote_level,
       w.parent AS parent_turn, coalesce(w.root, s.turn) AS thread_turn, CAST(coalesce(w.depth, 0) AS BIGINT) AS reply_depth
FROM split s LEFT JOIN ways w ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.turn = w.turn
"""


@_query("op7_quotation_links", OP7_SQL)
def op7_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    linked = quotes.link_quotes(table(spark, folder, "conversations"))
    return linked.select("conv_id", "turn", "role", "text", "quote_level", "parent_turn", "thread_turn", "reply_depth")


@_query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"), learn_from=~language.is_held_out(F.col("id")))
    return found.select(
        F.col("id").alias("doc_id"),
        "start",
        "end",
        language.is_held_out(F.col("id")).alias("held_out"),
        F.sha2("value", 256).alias("value_sha256"),
        "probability",
        "is_secret",
    )


OP13_SQL = r"""
WITH cleaned AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
grouped AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM cleaned GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM cleaned JOIN grouped USING (body)
"""


@_query("op13_block_names", OP13_SQL)
def op13_block_names(spark: SparkSession, folder: str) -> DataFrame:
    return copies.exact_copies(table(spark, folder, "documents"))


#: Words are damaged where this divides the checksum of id and word, so that there are variants to find.
DAMAGED = 199
OP12_SQL = f"""
WITH RECURSIVE bits AS (
  SELECT b AS byte, b AS x, 0 AS step FROM range(256) t(b) UNION ALL
  SELECT byte, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(CAST(x AS BIGINT) ORDER BY byte) AS of_byte FROM bits WHERE step = 8),
found AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
         unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]{{6,}}')) AS run
  FROM documents),
per_doc AS (SELECT doc, run, count(*) AS times FROM found GROUP BY ALL),
encoded AS (
  SELECT *, list_transform(string_split(doc || ':' || run, ''), lambda c: unicode(c)) AS points FROM per_doc),
hashed AS (
  SELECT run, times, xor(4294967295::BIGINT, list_reduce(
    flatten(list_transform(points, lambda p: CASE WHEN p < 128 THEN [p::BIGINT] ELSE [195::BIGINT, (p - 64)::BIGINT] END)),
    lambda s, b: xor(s >> 8, of_byte[xor(s, b) % 256 + 1]), 4294967295::BIGINT)) AS h
  FROM encoded, crc),
damaged AS (
  SELECT CASE WHEN h % {DAMAGED} = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
              ELSE run END AS word, times FROM hashed),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
-- Near words agree in what is left when each drops one place, or one drops a place and the other none.
cut AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words),
keys AS (
  SELECT word, n, substr(word, 1, p - 1) || substr(word, p + 1) AS rest, p FROM cut),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM keys a JOIN keys b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT k.word, k.n, w.word, w.n FROM keys k JOIN words w ON k.rest = w.word
  UNION SELECT w.word, w.n, k.word, k.n FROM keys k JOIN words w ON k.rest = w.word),
near AS (SELECT word, n, count(*) AS n_near, max(other_n) AS most FROM pairs GROUP BY ALL),
best AS (SELECT p.word, min(other) AS form, any_value(other_n) AS form_n FROM pairs p JOIN near USING (word)
         WHERE other_n = most AND other_n >= 5 * p.n GROUP BY p.word),
chain AS (
  SELECT word, word AS root, 0 AS depth FROM words UNION ALL
  SELECT c.word, b.form, depth + 1 FROM chain c JOIN best b ON c.root = b.word),
ends AS (SELECT word, root FROM chain QUALIFY row_number() OVER (PARTITION BY word ORDER BY depth DESC) = 1)
SELECT w.word, form, root, w.n, coalesce(n_near, 0) AS n_near, form_n
FROM words w LEFT JOIN near USING (word) LEFT JOIN best USING (word) JOIN ends USING (word)
"""


def damaged(doc_id: Column, run: Column) -> Column:
    """The run, without one code point where the checksum of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % DAMAGED == 0, cut).otherwise(run)


@_query("op12_spelling_groups", OP12_SQL)
def op12_spelling_groups(spark: SparkSession, folder: str) -> DataFrame:
    found = table(spark, folder, "documents").select("doc_id", F.explode(spelling.runs(F.col("text"), 6)).alias("run"))
    words = found.select(damaged(F.col("doc_id"), F.col("run")).alias("word"))
    return spelling.variants(spelling.counted(words, "word", 6, 5))


_NEXT_CENTROIDS = """
near_{i} AS (
  SELECT vec_id, v, c, d FROM (
    SELECT r, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM kept, centroids_{i})
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1),
sums_{i} AS (
  SELECT c, pos, sum(x) AS s, count(*) AS n
  FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS pos FROM near_{i}) GROUP BY c, pos),
means_{i} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS m FROM sums_{i} GROUP BY c),
centroids_{j} AS (
  SELECT c, coalesce(means_{i}.m, centroids_{i}.m) AS m FROM centroids_{i} LEFT JOIN means_{i} USING (c)),"""
OP11_SQL = (
    """
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
centroids_0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m
  FROM (SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT 16)),"""
    + "".join(_NEXT_CENTROIDS.format(i=i, j=i + 1) for i in range(4))
    + """
names AS (SELECT c, sha256(array_to_string(m, ',')) AS centroid_sha256 FROM centroids_3)
SELECT vec_id, CAST(c AS INT) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM near_3 JOIN names USING (c)
"""
)


@_query("op11_rotated_centroids", OP11_SQL)
def op11_rotated_centroids(spark: SparkSession, folder: str) -> DataFrame:
    found, means = centroids.clusters(table(spark, folder, "embeddings"))
    return centroids.summary(found, means).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
