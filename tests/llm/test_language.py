from __future__ import annotations

import zlib

import numpy as np
from brute import SMALL, frame  # noqa: F401

from tillroll.llm import language

SCHEMA = "doc_id long, text string, lang string, lang_pred string, score double"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = language.predict(docs, language.fit_not_held_out(docs)).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def some(frame):
    learn = [(i, "the cat and the dog with the hat", "en", "x", 0.0) for i in range(30)]
    learn += [(i + 30, "der hund und die katze mit dem hut", "de", "x", 0.0) for i in range(30)]
    return frame(learn + [(90, None, "en", "x", 0.0), (91, "foo", None, "x", 0.0)], SCHEMA)


def test_odd_texts(frame):
    filters = language.fit(some(frame))
    texts = [None, "", "123 !!", "THE DOG!", "die katze", "the cat " * 50_000, "Привет мир", "q"]
    table = frame([(i, t, None, "clash", 0.5) for i, t in enumerate(texts)] + [(None, "the", None, "c", 0.0)], SCHEMA)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(table, filters).collect()}
    assert [got[i][0] for i in range(6)] == ["und", "und", "und", "en", "de", "en"]
    assert got[0] == ("und", 0.0) and got[5][1] > 0.9 and got[6][1] == 0.0 and got[None][0] == "en"
    kept = language.keep_known(table, filters)
    assert kept.columns == table.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == [-1, 3, 4, 5]


def test_words_of_one_letter_count(frame):
    learn = [(i, "a cat and a dog", "en", "x", 0.0) for i in range(30)]
    learn += [(i + 30, "y el gato o el perro", "es", "x", 0.0) for i in range(30)]
    filters = language.fit(frame(learn, SCHEMA))
    table = frame([(i, t, None, "", 0.0) for i, t in enumerate(["A.", "y", "o y", "q", "1 !"])], SCHEMA)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(table, filters).collect()}
    assert [got[i][0] for i in range(3)] == ["en", "es", "es"] and all(got[i][1] > 0.9 for i in range(3))
    assert got[3][0] != "und" and got[3][1] == 0.0 and got[4] == ("und", 0.0)
    assert sorted(r.doc_id for r in language.keep_known(table, filters).collect()) == [0, 1, 2]


def test_nothing_to_learn_from(frame):
    filters = language.fit(frame([], SCHEMA))
    got = language.predict(frame([(1, "text", "en", "", 0.0)], SCHEMA), filters).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_grams_of_pieces_are_those_of_the_whole(monkeypatch):
    letters = language.letter_table()
    text = "Die Katze, the cat! " * 40
    whole = np.sort(np.concatenate(list(language._grams(text, letters, (2, 3)))))
    monkeypatch.setattr(language, "_PIECE", 17)
    assert (np.sort(np.concatenate(list(language._grams(text, letters, (2, 3))))) == whole).all()


def test_more_languages_than_bits(frame):
    names = [f"l{i:02d}" for i in range(70)]
    word = lambda i: "".join(chr(0x4E00 + 40 * i + k) for k in range(40))
    filters = language.fit(frame([(i, word(i), n, "", 0.0) for i, n in enumerate(names)], SCHEMA))
    assert [filters.decide(word(i))[0] for i in range(70)] == names
