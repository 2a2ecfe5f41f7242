from __future__ import annotations

import duckdb
import pyarrow as pa
from brute import frame  # noqa: F401

from tillroll.llm import quotes
from tillroll.llm.registry import OP7_SQL

SCHEMA = "conv_id long, turn long, role string, text string"
FIRST = "Hello all.\nIs the Build broken?\n\nI think so."
MESSAGES = [
    (1, 0, "a", FIRST),
    (1, 1, "b", "> Is the build  broken?\nNo, it is fine."),
    (1, 2, "c", ">> Is the Build broken?\n> No, it is fine.\nFor me it is not."),
    (1, 3, "a", "\n".join("> " + x for x in FIRST.split("\n")) + "\r\nSame question."),
    (1, 4, "b", "> nobody said this\nunlinked"),
    (1, 5, "b", ">>> deep\n>> No, it is fine.\nonly a deeper level is known"),
    (1, 6, "b", "> For me it is not.\n> No, it is fine.\ntwo parents"),
    (1, 7, "c", "> two parents"),
    (2, 0, "a", "> Is the Build broken?\nother conversation"),
    (2, 1, "a", "Hello all."),
    (2, 2, None, None),
    (2, 3, "a", ""),
    (None, 0, "a", "no conversation"),
    (None, 1, "a", "> no conversation"),
    (3, None, "a", "> Hello all."),
    (3, 1, "a", "> late\nlate"),
    (3, 1, "a", "> late\nlate"),
    (4, 0, "a", "start"),
    *[(4, k, "a", f"> {'start' if k == 1 else f'answer {k - 1}'}\nanswer {k}") for k in range(1, 40)],
    (5, 0, "a", "x\n" * 20_000 + "end"),
    (5, 1, "a", "> end\n" + "> x\n" * 20_000),
]


def linked(frame, messages=MESSAGES):
    return quotes.link_quotes(frame(messages, SCHEMA))


def test_parents_threads_and_texts(frame):
    got = {(r.conv_id, r.turn): r for r in linked(frame).collect()}
    parents = {k: r.parent_turn for k, r in got.items()}
    assert [parents[1, t] for t in range(8)] == [None, 0, 1, 0, None, 1, 2, 6]
    assert parents[2, 0] is None and parents[None, 1] == 0 and parents[3, None] is None and parents[3, 1] is None
    assert [got[1, t].thread_turn for t in range(8)] == [0, 0, 0, 0, 4, 0, 0, 0]
    assert [got[1, t].reply_depth for t in range(8)] == [0, 1, 2, 1, 0, 2, 3, 4]
    assert [got[1, t].quote_level for t in range(8)] == [0, 1, 2, 1, 1, 3, 1, 1]
    assert got[1, 3].text == "Same question." and got[1, 7].text == "" and got[2, 2].text is None
    assert all(got[4, k].thread_turn == 0 and got[4, k].reply_depth == k for k in range(40))
    assert parents[5, 1] == 0


def test_same_as_sql(frame):
    connection = duckdb.connect()
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    table = pa.table({n: pa.array([m[i] for m in MESSAGES], pa.string() if i > 1 else pa.int64()) for i, n in enumerate(names)})
    connection.register("conversations", table)
    cursor = connection.execute(OP7_SQL)
    columns = [d[0] for d in cursor.description]
    want = sorted(map(tuple, cursor.fetchall()), key=repr)
    assert sorted(map(tuple, linked(frame).select(*columns).collect()), key=repr) == want


def test_other_columns_stay(frame):
    rows = [(*m, 99, "clash") for m in MESSAGES[:3]]
    got = quotes.link_quotes(frame(rows, SCHEMA + ", parent_turn long, root string"))
    assert sorted(got.columns) == sorted(
        ["conv_id", "turn", "role", "text", "parent_turn", "root", "quote_level", "thread_turn", "reply_depth"]
    )
    assert sorted((r.turn, r.parent_turn, r.root) for r in got.collect() if r.turn) == [(1, 0, "clash"), (2, 1, "clash")]


def test_empty_table(frame):
    assert linked(frame, []).count() == 0
