"""Secret scans: candidate strings, and a random forest that removes false positives.

Candidates are long unbroken runs with a digit.  Features of a candidate: its length, the transitions
between kinds of characters, how much of it a dictionary of the corpus covers, its path, and the words
next to it.  A forest trained on labelled findings decides; what it takes for harmless is marked, not
lost.

Only DataFrame functions and Spark's own forest are used.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import matches
from tillroll.session import materialize

#: A run of key characters; shorter ones are no keys.
CANDIDATE = r"[A-Za-z0-9_/+=.-]{16,}+"
#: Names that stand before a secret.
KEYWORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "access_key", "auth", "bearer", "credential")
#: Words of a path that hint at material that is not live.
HARMLESS_PATHS = ("test", "example", "sample", "fixture", "mock", "docs")
#: Formats that are secrets by themselves, after public documentation of the issuers.
KNOWN = r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36}$|^xox[abprs]-[0-9A-Za-z-]{10,}$|^AIza[0-9A-Za-z_-]{35}$"
#: Most frequent words that make the dictionary.
DICTIONARY_WORDS = 5000
#: Bound of the labelled findings that the forest is trained on, chosen by a hash.
FIT_FINDINGS = 20_000
TREES, DEPTH, SEED = 30, 6, 8
FEATURES = (
    "length",
    "runs",
    "run_share",
    "digit_share",
    "upper_share",
    "distinct_share",
    "hex_only",
    "coverage",
    "keyword",
    "assigned",
    "quoted",
    "known_prefix",
    "harmless_path",
    "path_depth",
)


def candidates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Runs that may be secrets: ``(id, text_hash, start, end, value, before, after, path)``.

    Null and empty texts have none; repeated rows are scanned once.
    """
    named = docs.select(F.col(id_column), F.col(text), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"))
    maybe = F.col("text").rlike("[0-9]") & F.col("text").rlike("[A-Za-z0-9_/+=.-]{16}")
    found = matches(named, id_column, text, {"secret": (CANDIDATE, maybe)}, "path")
    # "token=abc" is one run: what stands before the sign is a neighbouring word, not the value.
    name = F.regexp_extract("value", r"^([A-Za-z_.-]+=)(?=[^=])", 1)
    split = (
        found.withColumn("name", name)
        .withColumn("value", F.regexp_replace(F.expr("substring(value, length(name) + 1)"), r"[.=]+$", ""))
        .withColumn("start", F.col("start") + F.length("name"))
        .withColumn("before", F.concat("before", "name"))
    )
    return split.filter(F.col("value").rlike("[0-9]") & (F.length("value") >= 16)).select(
        "id", "text_hash", "start", (F.col("start") + F.length("value")).alias("end"), "value", "before", "after", "path"
    )


def dictionary(docs: DataFrame, text: str = "text", words: int = DICTIONARY_WORDS) -> DataFrame:
    """``gram``: letter trigrams of the corpus's most frequent words; at most 26 ** 3 rows.

    Words are runs of 4 to 12 lower-case letters, counted over all texts.
    """
    word = F.explode(F.regexp_extract_all(F.col(text), F.lit(r"\b([a-z]{4,12}+)\b"), F.lit(1)))
    counted = docs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    frequent = counted.orderBy(F.col("n").desc(), "word").limit(words)
    starts = F.sequence(F.lit(1), F.length("word") - 2)
    return frequent.select(F.explode(F.transform(starts, lambda i: F.substring("word", i, 3))).alias("gram")).distinct()


def _share(value: Column, keep: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{keep}]", "")) / F.length(value)


def features(found: DataFrame, grams: DataFrame) -> DataFrame:
    """``found`` with the columns of ``FEATURES`` as doubles."""
    key = ["id", "text_hash", "start"]
    lower = F.lower("value")
    starts = F.sequence(F.lit(1), F.length("value") - 2)
    own = found.select(*key, F.explode(F.transform(starts, lambda i: F.substring(lower, i, 3))).alias("own_gram"))
    # The dictionary has at most 26 ** 3 rows of three letters.
    covered = (
        own.join(F.broadcast(grams.select("gram", F.lit(1).alias("hit"))), F.col("own_gram") == F.col("gram"), "left")
        .groupBy(*[F.col(k).alias(f"of_{k}") for k in key])
        .agg((F.count("hit") / F.count(F.lit(1))).alias("coverage"))
    )
    here = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_text_hash")) & (F.col("start") == F.col("of_start"))
    runs = F.length(F.regexp_replace("value", "[a-z]++|[A-Z]++|[0-9]++|[^a-zA-Z0-9]++", "x"))
    last_word = F.regexp_extract(F.lower("before"), r"([a-z_]+)[\s:=\"']*$", 1)
    columns = {
        "length": F.length("value"),
        "runs": runs,
        "run_share": runs / F.length("value"),
        "digit_share": _share(F.col("value"), "0-9"),
        "upper_share": _share(F.col("value"), "A-Z"),
        "distinct_share": F.size(F.array_distinct(F.split("value", ""))) / F.length("value"),
        "hex_only": F.col("value").rlike("^[0-9a-f]+$"),
        "coverage": F.coalesce("coverage", F.lit(0.0)),
        "keyword": last_word.isin(*KEYWORDS),
        "assigned": F.col("before").rlike(r"[:=]\s*[\"']?$"),
        "quoted": F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']"),
        "known_prefix": F.col("value").rlike("^(?:AKIA|ASIA|gh[pousr]_|xox[abprs]-|AIza|sk-|eyJ)"),
        "harmless_path": F.lower("path").rlike("|".join(HARMLESS_PATHS)),
        "path_depth": F.size(F.split("path", "/")),
    }
    return found.join(covered, here, "left").drop("of_id", "of_text_hash", "of_start").withColumns(
        {k: v.cast("double") for k, v in columns.items()}
    )


def known_labels(found: DataFrame) -> DataFrame:
    """Findings whose nature is certain, with ``is_secret``.

    Secrets: an issuer's full format, or a value of letters and digits assigned to a secret's name.
    Harmless: plain numbers, addresses and dotted words.  All others stay unlabelled.
    """
    name = "|".join(KEYWORDS)
    secret = F.col("value").rlike(KNOWN) | (
        F.lower("before").rlike(rf"(?:^|[^a-z])(?:{name})\s*[:=]\s*[\"']?$") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[0-9]")
    )
    harmless = F.col("value").rlike(r"^[0-9.+-]+$") | F.col("value").rlike(r"\.[a-z]{2,}$") | F.col("after").startswith("@") | F.col("before").endswith("@")
    label = F.when(secret, 1.0).when(harmless, 0.0)
    return found.withColumn("is_secret", label).filter("is_secret is not null")


def train(labelled: DataFrame, fit_findings: int = FIT_FINDINGS, trees: int = TREES, depth: int = DEPTH) -> PipelineModel | None:
    """A forest from findings with the feature columns and ``is_secret``; None if a class is missing.

    More than ``fit_findings`` are thinned to about that many by a hash of their place.
    """
    n = {r["is_secret"]: r["n"] for r in labelled.groupBy("is_secret").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return None
    draw = F.pmod(F.xxhash64("id", "text_hash", "start"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = labelled.filter(draw < min(1.0, fit_findings / sum(n.values())))
    # Both classes weigh the same.
    weight = F.when(F.col("is_secret") == 1, 0.5 / n[1.0]).otherwise(0.5 / n[0.0]) * sum(n.values())
    ready = materialize(chosen.withColumn("weight", weight).select(*FEATURES, "is_secret", "weight"))
    forest = RandomForestClassifier(
        labelCol="is_secret", weightCol="weight", numTrees=trees, maxDepth=depth, seed=SEED, featuresCol="features"
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), forest]).fit(ready)


def score(found: DataFrame, model: PipelineModel | None) -> DataFrame:
    """``found`` with ``probability``; without a model 1.0, so that nothing is removed unseen."""
    if model is None:
        return found.withColumn("probability", F.lit(1.0))
    scored = model.transform(found.drop("probability"))
    return scored.withColumn("probability", vector_to_array("probability")[1]).drop("features", "rawPrediction", "prediction")


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    path: str = "source",
    labelled=known_labels,
    learn_from: Column | None = None,
    least: float = 0.5,
    **options,
) -> DataFrame:
    """All candidates with features, ``probability`` and whether they are kept as secrets.

    ``labelled`` turns findings into labelled ones; ``learn_from`` picks the findings it may use.
    Rows ``(id, text_hash, start, end, value, ..., probability, is_secret)``.
    """
    found = materialize(candidates(docs, id_column, text, path))
    found = materialize(features(found, materialize(dictionary(docs, text))))
    learn = found if learn_from is None else found.filter(learn_from)
    model = train(labelled(learn), **options)
    return score(found, model).withColumn("is_secret", F.col("probability") >= least)
