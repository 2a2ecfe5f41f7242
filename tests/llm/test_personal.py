from __future__ import annotations

import hashlib
import random

import brute
from brute import SMALL, frame  # noqa: F401

from tillroll.llm import personal
from tillroll.llm.registry import op9_personal_data

SCHEMA = "doc_id long, text string, kind string, start int, value string"
TEXTS = [
    None,
    "",
    "a@b.com+c@d.com x",
    "1.2.3.4.5.6.7.8 300.1.1.1 +1 (2) 33 444 5555 4111 1111 1111 1111é 4111-1111-1111-1111",
    "1" * 30_000,
    "+" + "1 " * 20_000,
    "a" * 40_000 + " @ " + "b@" * 3000,
    "0001.0255.1.1 1.1.1.999 @x.com é@x.com ü\U0001f600 z@y.zz",
    "+4111 1111-1111 111",
    "x@y x@y.z. 4111111111111111 4111111111111112",
    "ask me@here.org now " * 2000,
]


def rows():
    out = [(i, t, "clash", 1, "clash") for i, t in enumerate(TEXTS)]
    return out + [out[2], (2, "same id x@y.zz", "c", 1, "c"), (None, "q@r.st", "c", 1, "c")]


def test_base_is_exact(frame):
    got = personal.per_document(frame(rows(), SCHEMA)).collect()
    want = []
    for i, text, *_ in rows():
        spans = brute.personal(text)
        counts = [sum(k == kind for k, *_ in spans) for kind in personal.KINDS]
        want.append((i, *counts, ",".join(f"{k}:{a}:{b}" for k, a, b in spans)))
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)


def test_texts_are_cut(frame):
    table = frame([(*r[:2], len(r[1] or ""), *r[2:]) for r in rows()], SCHEMA.replace("kind", "n_chars int, kind"))
    got = personal.redact(table, length="n_chars")
    assert got.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        ((i, brute.redacted(t)) for i, t, *_ in rows()), key=repr
    )
    assert all(r.n_chars == len(r.text or "") for r in got.collect())


def test_contexts_find_what_the_base_misses(frame):
    # Numbers that fail the checksum, in a context that otherwise holds cards only.
    good = ["4111111111111111", "5500000000000004", "340000000000009", "30000000000004", "6011000000000004"]
    texts = [f"some word{i} my card number {n} thanks a{i} lot" for i, n in enumerate(good)]
    bad = "my card number 4111111111111119 thanks"
    other = [f"row{i} serial id 900000000000{i:04d} end{i}" for i in range(6)]
    table = frame([(i, t) for i, t in enumerate([*texts, bad, *other])], "doc_id long, text string")
    got = {r.doc_id: r for r in personal.per_document(table).collect()}
    assert all(got[i].n_card == 1 and got[i].spans == got[i].base_spans for i in range(5))
    assert got[5].base_spans == "" and got[5].spans == "card:15:31"
    assert all(got[i].spans == got[i].base_spans for i in range(6, 12))
    cut = {r.doc_id: r.text for r in personal.redact(table).collect()}
    assert cut[5] == "my card number <CARD> thanks" and cut[6] == other[0]


def with_check_digit(body):
    digits = [int(c) for c in reversed(body)]
    total = sum(d if i % 2 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits))
    return body + str(-total % 10)


def test_found_values_lead_to_new_patterns(frame):
    good = [with_check_digit(f"4{i:02d}000000000000") for i in range(18)]
    bad = [n[:-1] + str((int(n[-1]) + 1) % 10) for n in (with_check_digit(f"5{i:02d}000000000000") for i in range(4))]
    # Three numbers are found next to 16 cards; with two more cards they make up the context of the fourth.
    texts = [f"some w{i} my card number {n} t{i} lot" for i, n in enumerate(good[:16] + bad[:3])]
    texts += [f"x{i} please charge it {n} z{i} soon" for i, n in enumerate(good[16:] + bad)]
    got = {r.doc_id: r for r in personal.per_document(frame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [r for r in range(len(texts)) if got[r].spans.count("card:") != 1] == []
    assert [got[i].n_card for i in (18, 19, 20, 21, 24)] == [0, 1, 1, 0, 0]


def spans_of(frame, texts):
    got = personal.per_document(frame(list(enumerate(texts)), "doc_id long, text string"))
    return {r.doc_id: r.spans for r in got.collect()}


def test_contexts_of_whole_words(frame):
    good = [with_check_digit(f"4{i:02d}000000000000") for i in range(24)]
    bad = good[0][:-1] + str((int(good[0][-1]) + 1) % 10)
    tail, long = "x" * 70, "n" * 90 + "@" + "h" * 300
    texts = [f"q{i} r{i} a{tail} {n} t{i} lot" for i, n in enumerate(good)]
    texts += [f"w{i} phone number: +49 30 5550{i:02d} x{i} bye" for i in range(24)]
    texts += [f"v{i} write me at joe{i}@example.org now{i} ok" for i in range(24)]
    texts += [f"w{i} a{i}@example.org b{i}@example.org t{i} lot" for i in range(24)]
    cases = {
        # Words that differ only beyond 60 letters are different words.
        f"q r a{tail} {bad} k1 lot": f"card:{6 + 70}:{6 + 70 + 16}",
        f"q r b{tail} 4999999999999977 k2 lot": "",
        # Two long numbers with a blank between are two, shorter groups are one.
        "w phone number: 12345671 12345672 k3 bye": "phone:16:24",
        "w phone number: 555 123 4567 k4 bye": "phone:16:28",
        f"v write me at {long} k5 ok": f"email:14:{14 + len(long)}",
        # The find before is part of the context.
        "z a0@example.org mm@intranet k6 lot": "email:2:16,email:17:28",
        "z here nn@intranet k7 lot": "",
    }
    table = frame(list(enumerate([*texts, *cases])), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in personal.per_document(table).collect()}
    assert [got[len(texts) + i] for i in range(len(cases))] == [*cases.values()]


def test_planted_contexts(frame):
    """Addresses without a dot and numbers without a valid digit, in contexts that name sure ones."""
    draw, texts, planted = random.Random(3), [], {}
    kinds = {
        "email": ("reach me via", lambda: f"u{draw.randrange(10**6)}@site{draw.randrange(99)}.org", lambda: f"u{draw.randrange(10**6)}@intranet"),
        "phone": ("call us on", lambda: f"+49 30 {draw.randrange(10**6, 10**7)}", lambda: f"0{draw.randrange(10**8, 10**9)}"),
        "card": ("charge the card", lambda: with_check_digit(f"4{draw.randrange(10**13, 10**14)}"), lambda: f"4{draw.randrange(10**14, 10**15)}"),
    }
    for i in range(600):
        kind, (context, sure, hidden) = list(kinds.items())[i % 3]
        value = hidden() if i % 10 == 0 else sure()
        lead = f"note{i} word{draw.randrange(50)} "
        if i % 10 == 0:
            start = len(lead) + len(context) + 1
            planted[i] = f"{kind}:{start}:{start + len(value)}"
        texts.append(f"{lead}{context} {value} tail{i} end")
    texts += [f"row{i} serial {draw.randrange(10**12, 10**15)} part{i} of {draw.randrange(10**7, 10**9)}" for i in range(300)]
    found = personal.per_document(frame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id: r.spans for r in found}
    assert sum(span in got[i].split(",") for i, span in planted.items()) >= 0.9 * len(planted)
    base = {i: ",".join(f"{k}:{a}:{b}" for k, a, b in brute.personal(t)) for i, t in enumerate(texts)}
    assert [i for i in range(600, 900) if got[i] != base[i]] == []


def test_empty_table(frame):
    table = frame([], SCHEMA)
    assert personal.per_document(table).count() == 0 and personal.redact(table).count() == 0


def test_given_documents(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in op9_personal_data(spark, SMALL).collect():
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b in brute.personal(text[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert {*filter(None, spans.split(","))} <= {*r.spans.split(",")}
