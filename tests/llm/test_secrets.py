from __future__ import annotations

import hashlib
import random

from brute import SMALL, frame  # noqa: F401
from pyspark.sql import functions as F

from tillroll.llm import secrets
from tillroll.llm.registry import op8_secret_scan

SCHEMA = "doc_id long, text string, source string, value string, probability double"


def hexes(draw, n):
    return "".join(draw.choice("0123456789abcdef") for _ in range(n))


def corpus(n=240):
    draw, rows = random.Random(4), []
    for i in range(n):
        words = " ".join(draw.choice(["house", "garden", "river", "mountain", "window"]) for _ in range(30))
        secret, number = hexes(draw, 32), "".join(draw.choice("0123456789") for _ in range(16))
        middle = [f'token = "{secret}"', f"call {number} now", f"see mail{i % 9}.garden.example.com", f"password={secret[:18]}"][i % 4]
        rows.append((i, f"{words} {middle} {words}", "src/app.py", "clash", 9.0))
    return rows


def test_forest_tells_secrets_from_numbers(frame):
    got = secrets.scan(frame(corpus(), SCHEMA), learn_from=F.col("id") % 3 != 0).filter("id % 3 = 0").collect()
    assert len(got) == 80
    assert all(r.is_secret == (r.id % 4 in (0, 3)) for r in got)


def test_places_and_odd_texts(frame):
    secret = "0123456789abcdef0123"
    texts = [None, "", "short abc1", f"é token={secret}!", secret, "a1" * 40_000, f"x {secret} y {secret}", "nodigitsinthisverylongrun"]
    rows = [(i, t, None, "c", 1.0) for i, t in enumerate(texts)] + [(4, secret, "tests/x", "c", 1.0), (None, secret, "p", "c", 1.0)]
    rows.append(rows[3])
    got = secrets.scan(frame(rows, SCHEMA)).collect()
    places = sorted(((r.id, r.start, r.end, r.value) for r in got), key=repr)
    want = [(3, 8, 28, secret), (4, 0, 20, secret), (5, 0, 80_000, "a1" * 40_000), (6, 2, 22, secret), (6, 25, 45, secret), (None, 0, 20, secret)]
    assert places == sorted(want, key=repr)
    assert all(r.is_secret for r in got)  # one class only: nothing is learned, so nothing is removed


def test_empty_table(frame):
    assert secrets.scan(frame([], SCHEMA)).count() == 0


def test_planted_secrets_are_kept(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    known = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("(AKIA[0-9A-Z]{16})"), F.lit(1))).alias("v"))
    want = {(r.doc_id, hashlib.sha256(r.v.encode()).hexdigest()) for r in known.collect()}
    kept = {(r.doc_id, r.value_sha256) for r in op8_secret_scan(spark, SMALL).collect() if r.is_secret}
    assert want <= kept
