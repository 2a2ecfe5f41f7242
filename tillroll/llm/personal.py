"""Personal data by patterns that are bootstrapped from certain finds.

Base finds (addresses, IP numbers, cards, phone numbers) follow fixed expressions and checks.  They are
the seeds: the words around them become lexical patterns, pattern and value form a graph, and both sides
are scored in turns.  A pattern is as sure of a kind as the share of its values that belong to it; a
value is as sure as its patterns together.  Values that the base expressions miss, but that sure
patterns name, are added; they strengthen their patterns and make others sure in the next round, until
nothing new appears.

Only DataFrame functions are used.  A text is read once; what leaves that stage are finds with a few
words around them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import broadcast_keys, matches, same
from tillroll.session import materialize

#: Kinds in the order of the results.
KINDS = ("email", "ip", "card", "phone")
_MAIL_CHARS = "A-Za-z0-9._%+-"
# The contract's expressions.  Possessive repeats and the look behind only keep long runs linear: no
# match can begin inside a run unless the match before ended there, which is what \G allows for.
_BASE = {
    "email": rf"(?:\G|(?<![{_MAIL_CHARS}]))[{_MAIL_CHARS}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Anything that looks like an address or a number; what the base misses can be found among these.  Two
#: numbers of seven digits or more with a blank between are two candidates, groups of fewer digits are one.
_CANDIDATE = (
    r"(?:\G|(?<![^\s@]))[^\s@]++@[^\s@]++"
    r"|[0-9]{7,}+(?=\x20{1,2}[0-9]{7})"
    r"|\+?[0-9](?:[\x20().-]{0,2}+[0-9])++"
)
#: Stands for a neighbouring find in a pattern.
_FIND = "<>"
_GUARDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){12}",
    "phone": "+",
    "candidate": r"@|[0-9](?:[\x20().-]{0,2}[0-9]){6}",
}
#: Patterns and values are scored until there is no new value and the scores rise by no more in all.
_STILL = 1e-6
#: Different sure values that a pattern needs, and the share of sure values among its values.
SUPPORT = 3
PATTERN_CONFIDENCE = 0.8
#: From this score on a value counts as found.
VALUE_CONFIDENCE = 0.9


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass the Luhn check."""
    reversed_digits = F.split(F.reverse(digits), "")

    def worth(d: Column, i: Column) -> Column:
        doubled = 2 * d.cast("int")
        return F.when(i % 2 == 0, d.cast("int")).otherwise(doubled - F.when(doubled > 9, 9).otherwise(0))

    total = F.aggregate(F.transform(F.filter(reversed_digits, lambda d: d != ""), worth), F.lit(0), lambda a, d: a + d)
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    """Whether a match of a base expression passes the checks of its kind."""
    digits = _digits(value)
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(
        parts, lambda p: F.when(F.length(p) == 0, True).when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False)
    )
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", small)
        .when(kind == "card", F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False))
        .otherwise(F.length(digits).between(9, 15))
    )


def _shape(value: Column) -> Column:
    """The kind that a candidate looks like, null if none."""
    n = F.length(_digits(value))
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(r"^[0-9]{1,4}(?:\.[0-9]{1,4}){2,4}$"), "ip")
        .when(value.rlike(r"^\+|\(") & n.between(7, 15), "phone")
        .when(n.between(12, 19), "card")
        .when(n.between(7, 11), "phone")
    )


def _words_before(gap: Column) -> Column:
    """Up to two whole words at the end, read from the end so that a long gap is no work."""
    return F.reverse(F.regexp_extract(F.reverse(gap), r"^\s*+(\S*+(?:\s++\S++)?)", 1))


def _word_after(gap: Column) -> Column:
    return F.regexp_extract(gap, r"^\s*+(\S++)", 1)


def _finds(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """Valid base finds, and candidates that overlap none of them.

    ``(id, text_hash, kind, start, end, value, before, after, base)`` in code points, end exclusive;
    ``before`` and ``after`` are up to two words and one word next to the find, whole and lower-cased.  A
    neighbouring find of the same expression stands there as ``<>``, whatever its value.
    """
    whole = F.col("text")
    guarded = {k: (e, whole.contains(_GUARDS[k]) if _GUARDS[k] in "@+" else whole.rlike(_GUARDS[k])) for k, e in {**_BASE, "candidate": _CANDIDATE}.items()}
    placed = matches(docs, id_column, text, guarded, before=_words_before, after=_word_after)
    # A gap of fewer than two words brings the find on its other side into the context.
    line = Window.partitionBy("id", "text_hash", "kind").orderBy("at")
    short = (F.col("at") > 0) & ~F.col("before").rlike(r"\S\s+\S")
    placed = placed.withColumns(
        {
            "before": F.when(short, F.concat_ws(" ", F.lit(_FIND), F.nullif("before", F.lit("")))).otherwise(F.col("before")),
            "after": F.when((F.col("after") == "") & F.lead("at").over(line).isNotNull(), _FIND).otherwise(F.col("after")),
            "base": F.col("kind") != "candidate",
        }
    )
    kept = placed.withColumn("kind", F.when(F.col("base"), F.col("kind")).otherwise(_shape(F.col("value")))).filter(
        F.col("kind").isNotNull() & (~F.col("base") | _valid(F.col("kind"), F.col("value")))
    )
    in_doc = Window.partitionBy("id", "text_hash").orderBy("start", F.col("base").desc(), "end")
    back = in_doc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = in_doc.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    reached = F.max(F.when(F.col("base"), F.col("end"))).over(back)
    coming = F.min(F.when(F.col("base"), F.col("start"))).over(ahead)
    clear = (F.coalesce(reached, F.lit(0)) <= F.col("start")) & (F.coalesce(coming, F.col("end")) >= F.col("end"))
    before, after = F.lower("before"), F.lower("after")
    return (
        kept.withColumn("clear", clear)
        .filter("base or clear")
        .select("id", "text_hash", "kind", "start", "end", "value", before.alias("before"), after.alias("after"), "base")
    )


def _graph(finds: DataFrame) -> DataFrame:
    """``(kind, pattern, value, base)``: which value stands in which pattern, each pair once."""
    two = F.regexp_replace("before", r"\s+", " ")
    one = F.regexp_extract("before", r"(\S+)$", 1)
    patterns = F.array(
        F.when(two != "", F.concat(two, F.lit(" _"))),
        F.when((one != "") & (one != two), F.concat(one, F.lit(" _"))),
        F.when((one != "") & (F.col("after") != ""), F.concat(one, F.lit(" _ "), F.col("after"))),
        F.when(F.col("after") != "", F.concat(F.lit("_ "), F.col("after"))),
    )
    edges = finds.select("kind", F.explode(patterns).alias("pattern"), F.lower("value").alias("value"), "base")
    return edges.filter("pattern is not null").groupBy("kind", "pattern", "value").agg(F.max("base").alias("base"))


def bootstrap(
    finds: DataFrame,
    rounds: int | None = None,
    support: int = SUPPORT,
    pattern_confidence: float = PATTERN_CONFIDENCE,
    value_confidence: float = VALUE_CONFIDENCE,
) -> tuple[DataFrame, DataFrame]:
    """Sure patterns ``(kind, pattern, confidence)`` and new values ``(kind, value, score)``.

    A pattern's confidence in a kind is the sum of its values' scores over the number of all its
    different values of any kind; base values score 1, others what the last round gave them.  Values
    that were found make new patterns sure.  Rounds go on until nothing new appears; ``rounds`` bounds them.
    """
    edges = materialize(_graph(finds))
    n_values = edges.groupBy("pattern").agg(F.count_distinct("value").alias("n"))
    totals = materialize(n_values.filter(F.col("n") >= support))
    others = edges.filter(~F.col("base"))
    seeds = edges.filter("base").groupBy("kind", "pattern").agg(F.sum(F.lit(1.0)).alias("score"), F.count(F.lit(1)).alias("sure"))
    seeds = materialize(seeds)
    values, patterns, n_before, sum_before, turn = None, None, 0, 0.0, 0
    while rounds is None or turn < rounds:
        turn += 1
        scored = seeds
        if values is not None:
            known = others.join(broadcast_keys(values.withColumnRenamed("score", "s")), ["kind", "value"])
            more = known.groupBy("kind", "pattern").agg(F.sum("s").alias("score"), F.count(F.lit(1)).alias("sure"))
            both = seeds.unionByName(more).groupBy("kind", "pattern")
            scored = both.agg(F.sum("score").alias("score"), F.sum("sure").alias("sure"))
        patterns = materialize(
            scored.filter(F.col("sure") >= support)
            .join(totals, "pattern")
            .withColumn("confidence", F.col("score") / F.col("n"))
            .filter(F.col("confidence") >= pattern_confidence)
            .select("kind", "pattern", "confidence")
        )
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))
        values = materialize(
            others.join(broadcast_keys(patterns), ["kind", "pattern"])
            .groupBy("kind", "value")
            .agg((1 - doubt).alias("score"))
            .filter(F.col("score") >= value_confidence)
        )
        # Scores only rise from round to round; where they stand still, nothing new can follow.
        n, total = values.agg(F.count(F.lit(1)), F.coalesce(F.sum("score"), F.lit(0.0))).first()
        if n == n_before and total - sum_before <= _STILL:
            break
        n_before, sum_before = n, total
    return patterns, values


def personal_data(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Finds ``(id, text_hash, kind, start, end, value, base)``, once per different row of ``docs``.

    Null and empty texts have none.  Rows with one id are told apart by ``text_hash``, the text's
    xxhash64.  Base finds always stay; bootstrapped ones overlap none of them.
    """
    finds = materialize(_finds(docs, id_column, text))
    _, values = bootstrap(finds, **options)
    known = values.select(F.col("kind").alias("k"), F.col("value").alias("v"))
    new = finds.filter(~F.col("base")).join(
        known, (F.col("kind") == F.col("k")) & (F.lower("value") == F.col("v")), "left_semi"
    )
    return finds.filter("base").unionByName(new).drop("before", "after")


def _kind_order(kind: Column) -> Column:
    return reduce(lambda c, k: c.when(kind == k[1], k[0]), enumerate(KINDS[1:], 1), F.when(kind == KINDS[0], 0))


def per_document(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document row: ``(id, n_<kind> ..., base_spans, spans)``.

    Spans are ``kind:start:end``, by kind and start, comma-joined; counts are those of base finds.
    """
    found = personal_data(docs, id_column, text, **options)
    entry = F.struct(
        _kind_order(F.col("kind")).alias("order"),
        "start",
        "end",
        F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string")).alias("name"),
    )
    names = lambda c: F.array_join(F.transform(F.sort_array(c), lambda s: s["name"]), ",")
    by_doc = found.groupBy(F.col("id").alias("found_id"), F.col("text_hash").alias("found_hash")).agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        names(F.collect_list(F.when(F.col("base"), entry))).alias("base_spans"),
        names(F.collect_list(entry)).alias("spans"),
    )
    own = docs.select(F.col(id_column), F.xxhash64(text).alias("text_hash"))
    both = same(F.col(id_column), F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))
    return own.join(by_doc, both, "left").select(
        id_column,
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.coalesce("base_spans", F.lit("")).alias("base_spans"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redact(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: str | None = None, **options
) -> DataFrame:
    """``docs`` with every find in the text replaced by its kind in angle brackets; all columns.

    Overlapping finds are replaced together, by the first one's kind.  Other texts stay as they are.
    ``length`` names a column with the text's code points, which follows where the text changes.
    """
    found = personal_data(docs, id_column, text, **options)
    order = Window.partitionBy("id", "text_hash").orderBy("start", F.col("end").desc(), "kind")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    groups = found.withColumn("fresh", F.coalesce(F.col("start") >= before, F.lit(True)).cast("int")).withColumn(
        "stretch", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    cuts = groups.groupBy("id", "text_hash", "stretch").agg(
        F.min("start").cast("int").alias("start"),
        F.max("end").cast("int").alias("end"),
        F.min_by("kind", F.struct("start", -F.col("end"), "kind")).alias("kind"),
    )
    cuts = materialize(
        cuts.groupBy(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).agg(
            F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("__cuts")
        )
    )
    whole = F.col(text)

    def piece(cut: Column, i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get("__cuts", i - 1)["end"])
        kept = F.substring(whole, start + 1, cut["start"] - start)
        return F.concat(kept, F.lit("<"), F.upper(cut["kind"]), F.lit(">"))

    last = F.element_at("__cuts", -1)["end"]
    tail = F.substring(whole, last + 1, F.char_length(whole))
    cut_text = F.concat(F.array_join(F.transform("__cuts", piece), ""), tail)
    both = same(F.col(id_column), F.col("__id")) & (F.xxhash64(text) == F.col("__hash"))
    kept = F.col("__cuts").isNull()
    out = docs.join(broadcast_keys(cuts, 32 + 24 * F.size("__cuts")), both, "left").withColumn(text, F.when(kept, whole).otherwise(cut_text))
    if length:
        kind = docs.schema[length].dataType
        out = out.withColumn(length, F.when(kept, F.col(length)).otherwise(F.char_length(text).cast(kind)))
    return out.drop("__id", "__hash", "__cuts")
