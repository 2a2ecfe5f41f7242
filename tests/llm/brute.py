"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re

import pytest

SMALL = "/root/testdata/sf0.001"

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.fixture(scope="session")
def frame(spark):
    """Rows and a schema to a DataFrame; works for no rows too."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def contamination(text, items, n=13):
    """``(n_words, n_hit, items)`` of a text; ``items``: id to text."""
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        size = min(n, len(w))
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(own) - size + 1):
            if windows and tuple(own[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


def components(values, near):
    """Smallest position reachable from each value over pairs that are ``near``."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (2 * d > 9)
    return total % 10 == 0


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    """Valid base spans ``(kind, start, end)`` in order."""
    out = []
    for kind, expression in PERSONAL.items():
        for m in re.finditer(expression, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            valid = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }
            if valid[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def redacted(text):
    out, at = "", 0
    spans = sorted(personal(text), key=lambda s: (s[1], -s[2], s[0]))
    while spans:
        kind, start, end = spans.pop(0)
        while spans and spans[0][1] < end:
            end = max(end, spans.pop(0)[2])
        out, at = f"{out}{text[at:start]}<{kind.upper()}>", end
    return out + text[at:] if at else text


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def taken_text(text, times):
    """The words of ``text`` that are taken, ``times`` holding how often each is."""
    words = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text or "")
    copies = [[w for w, n in zip(words, times, strict=True) if n >= c] for c in range(1, max(times, default=0) + 1)]
    return "\n".join("".join(c) for c in copies)


def _deal(parties, seats):
    """Highest quotients; ``parties``: ``(votes, most)`` in order of preference."""
    won = [0] * len(parties)
    for _ in range(seats):
        open_ = [i for i, (v, most) in enumerate(parties) if v > 0 and won[i] < most]
        if not open_:
            break
        won[max(open_, key=lambda i: (parties[i][0] / (2 * won[i] + 1), -i))] += 1
    return won


def mix(docs, block=32, shard_rows=4096, seed="mix-1", weights=(5, 2, 1), share=1.5, most=2, times_of=None):
    """``(doc_id, size, source_size, target, taken)`` of documents ``(doc_id, source, size)``.

    ``times_of`` (a dict) receives how often each word of a document is taken.
    """
    text = lambda x: "null" if x is None else str(x)
    digest = lambda *p: hashlib.md5("|".join([seed, *map(text, p)]).encode()).hexdigest()
    names = sorted({s for _, s, _ in docs if s is not None}, key=lambda s: s.encode())
    names += [None] * any(s is None for _, s, _ in docs)
    sizes = {s: sum(n for _, x, n in docs if x == s) for s in names}
    rows = {s: sum(x == s for _, x, _ in docs) for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped, level = share * sum(sizes.values()), set(), 0.0
    while True:
        free = sum(weight[s] for s in names if s not in capped)
        if not free:
            break
        level = (total - sum(most * sizes[s] for s in capped)) / free
        over = {s for s in names if weight[s] * level > most * sizes[s]}
        if over == capped:
            break
        capped = over
    target = {s: min(float(most * sizes[s]), weight[s] * level) for s in names}
    blocks = lambda n: -(-n // block)
    seats = _deal([(target[s], most * blocks(sizes[s])) for s in names], int(sum(target.values()) / block + 0.5))
    out = []
    for s, quota in zip(names, seats):
        shards = {}
        for d, x, n in docs:
            if x == s:
                key = digest(d)
                shards.setdefault(int(key[:8], 16) % math.ceil(rows[s] / shard_rows), []).append((key, d, n))
        order = sorted(shards)
        held = [sum(n for *_, n in shards[k]) for k in order]
        for k, h, q in zip(order, held, _deal([(h, most * blocks(h)) for h in held], quota)):
            n_blocks = blocks(h)
            offset = int(digest(s, k)[:8], 16) % max(n_blocks, 1)
            times = [((j + 1) * q + offset) // n_blocks - (j * q + offset) // n_blocks for j in range(n_blocks)]
            at = 0
            for _, d, n in sorted(shards[k], key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])):
                each = [times[w // block] for w in range(at, at + n)]
                out.append((d, n, sizes[s], target[s], sum(each)))
                if times_of is not None:
                    times_of[d] = each
                at += n
    return out
