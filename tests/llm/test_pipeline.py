from __future__ import annotations

import brute
import corpus_pipeline
import pytest
from brute import SMALL, frame  # noqa: F401

import __spark_entry__ as entry
from tillroll.llm import language, simhash, stages
from tillroll.llm.registry import QUERIES
from tillroll.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain(docs, filters, items):
    """The stages on rows ``(doc_id, text, lang, source, n_chars)``, in plain Python."""
    known = [filters.decide(r[1]) for r in docs]
    docs = [r for r, (name, score) in zip(docs, known) if name != "und" and score >= language.LEAST_SCORE]
    docs = sorted(docs)
    fps = [simhash.fingerprint(r[1]) for r in docs]
    root = brute.components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    docs = [r for i, r in enumerate(docs) if root[i] == i]
    found = [brute.contamination(r[1], items) for r in docs]
    docs = [r for r, (n, h, _) in zip(docs, found) if not (h and 20 * h >= n)]
    cut = [(r, brute.redacted(r[1])) for r in docs]
    docs = [(r[0], t, r[2], r[3], r[4] if t == r[1] else len(t)) for r, t in cut]
    times = {}
    mixed = {m[0]: m for m in brute.mix([(r[0], r[3], brute.size(r[1])) for r in docs], times_of=times)}
    cut = [(r, brute.taken_text(r[1], times[r[0]])) for r in docs]
    docs = [(r[0], t, r[2], r[3], r[4] if t == r[1] else len(t)) for r, t in cut]
    return sorted((*r, *mixed[r[0]][1:]) for r in docs if mixed[r[0]][4] > 0)


@pytest.fixture(scope="module")
def stepped(spark):
    """What every stage returns, written and read again."""
    out = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SMALL)))
    return out


def test_same_as_brute_force(spark, stepped):
    docs = sorted(map(tuple, stepped[0].select(*COLUMNS).collect()))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = plain(docs, language.fit_not_held_out(stepped[0]), items)
    order = [*COLUMNS, "size", "source_size", "target", "taken"]
    assert sorted(map(tuple, stepped[-1].select(*order).collect())) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select(*order).collect())) == want


def test_words_follow_the_targets(stepped):
    held, targets = {}, {}
    for r in stepped[-1].collect():
        assert brute.size(r.text) == r.taken and r.n_chars == len(r.text)
        held[r.source] = held.get(r.source, 0) + r.taken
        targets[r.source] = r.target
    assert all(abs(held[s] - targets[s]) <= 0.02 * targets[s] + 64 for s in held)


def test_every_stage_but_the_last_returns_documents(stepped):
    assert all(df.columns == COLUMNS for df in stepped[:-1])
    assert {*COLUMNS, "taken"} <= {*stepped[-1].columns}


def test_stages_on_odd_documents(spark, frame):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, digest string"
    rows = [(None, None, None, None, None, 1, "c"), (1, "", "en", "s", 0, 1, "c"), (2, "12 34", None, "s", 5, 1, "c")]
    rows += [(i, f"the cat sat on mat number {i} and saw a{i} dog", "en", "s", 40, 1, "c") for i in range(3, 40)]
    rows += [rows[5], rows[5], (5, "other text with the same id and the cat", "en", None, 40, 1, "c")]
    for table in (frame(rows, schema), frame([], schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, table, SMALL)
            assert got.columns == table.columns, name
            assert got.count() <= table.count()
        assert stages.mixed(spark, table, SMALL).count() <= table.count()


def test_registered(spark):
    queries = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert queries["pipeline"] is corpus_pipeline.run and {*QUERIES} <= {*queries}
