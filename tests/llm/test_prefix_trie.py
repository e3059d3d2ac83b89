"""The conversation trie against a dictionary of prefixes."""

import random
import zlib
from hashlib import sha256

import pytest

from corvane.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, idx string, depth int, n_convs string"


def brute(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: (t[:2], t[2].encode(), t[3].encode()))] for c, turns in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    nodes = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children, leaves, saved = ({p: 0 for p in nodes} for _ in range(3))
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] += children[p] == 0
        saved[p] += (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0
        if p:
            children[p[:-1]] += 1
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                   sha256(",".join(str(c) for c in sorted(m) if whole[c] == p).encode()).hexdigest()) for p, m in nodes.items())


def made(seed, convs, longest, texts=3):
    draw = random.Random(seed)
    rows = [(c, t, draw.choice(["user", "assistant"]), f"é{draw.randrange(texts)}" * draw.randrange(3), "i", 0, "n")
            for c in convs for t in range(draw.randrange(1, longest))]
    draw.shuffle(rows)
    return rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1], r[2] or 0))


@pytest.mark.parametrize("limits", [{}, {"heavy": 10, "least": 3, "band": 4, "queue": 5}, {"heavy": 1, "least": 10**6, "band": 3, "queue": 1}])
def test_equals_brute_force(spark, limits):
    rows = made(1, range(120), 14) + [(1000, t, "user", "ab"[t % 2], None, 0, None) for t in range(90)]
    rows += [(1001 + c, t, "user", "ab"[t % 2], None, 0, None) for c in range(6) for t in range(60 + c % 2)]  # long copies
    got = prefix_trie.trie(spark.createDataFrame(rows, TURNS), **limits)
    assert rows_of(got) == brute(rows)


def test_odd_rows(spark):
    long = "x" * 200_000
    rows = [(None, 1, "user", "no id", None, 0, None), (7, None, None, None, "i", 1, "n"), (7, None, "a", "", None, 1, None),
            (7, 3, "user", "tie b", None, 1, None), (7, 3, "user", "tie a", None, 1, None), (7, 3, "user", "tie a", None, 1, None),
            (11, 1, "user", long, None, 1, None), (10, 1, "user", long, None, 1, None), (-3, 1, "u", "q", None, 1, None), (-5, 2, "u", "r", None, 1, None),
            (0, 1, "u", "zero", None, 1, None), (3, 0, "u", "q", None, 1, None)]
    assert rows_of(prefix_trie.trie(spark.createDataFrame(rows, TURNS))) == brute(rows)
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame(rows[:1], TURNS)).count() == 0


def test_queue_gives_messages_in_order_after_spilling():
    draw, queue = random.Random(5), prefix_trie.SpillingQueue(limit=7)
    items = [(draw.randrange(9), draw.randrange(3), 0, i, -i) for i in range(500)]
    for item in items:
        queue.push(item)
    got = [list(queue.pop_at(key)) for key in sorted({i[:3] for i in items})]
    assert [sorted(g) for g in got] == [sorted(i for i in items if i[:3] == key) for key in sorted({i[:3] for i in items})]
    assert len(queue) == 0
