"""The record of a key: same decisions as a list of all times, and small while a key keeps repeating."""

from __future__ import annotations

import random

import pytest

from tillroll.streaming.queue import let_through


@pytest.mark.parametrize("seed", range(20))
def test_spans_decide_like_a_list_of_times(seed):
    draw = random.Random(seed)
    starts, ends, passed = [], [], []
    for _ in range(400):
        t = draw.randrange(-500, 500)
        want = all(abs(t - x) >= 7 for x in passed)
        assert let_through(starts, ends, t, 7) == want
        passed += [t] * want
        assert starts == sorted(starts) and all(a <= b for a, b in zip(starts, ends))
        assert all(b - a >= 14 for a, b in zip(ends, starts[1:]))


@pytest.mark.parametrize("late", [False, True])
def test_a_key_that_keeps_repeating_holds_one_span(late):
    draw = random.Random(1)
    starts, ends, times = [], [], list(range(0, 100_000, 3))
    if late:
        draw.shuffle(times)
    n = sum(let_through(starts, ends, t, 10) for t in times)
    assert n > 5000
    # Out of order, gaps of two steps stay open in which no time of this key happens to fall.
    assert len(starts) == len(ends) and (len(starts) < n / 5 if late else len(starts) == 1)
