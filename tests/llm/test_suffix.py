import random

import numpy as np
import pytest

import brute
from conftest import DOCUMENTS, odd_rows
from txnlab.llm import suffix as S


def check(spark, rows, group_rows=S.GROUP_ROWS):
    docs = spark.createDataFrame(rows, DOCUMENTS)
    got = S.remove_repeats(docs, group_rows=group_rows).collect()
    want = [(r[0], *x) for r, x in zip(rows, brute.remove_repeats([r[1] for r in rows], S.LENGTH))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def passages(n=60, seed=3):
    rnd = random.Random(seed)
    letters = lambda k, abc="abcdefgh ": "".join(rnd.choices(abc, k=k))
    shared = [letters(rnd.randrange(150, 700)) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            parts.append(letters(rnd.randrange(400)))
            if rnd.random() < 0.7:
                s = rnd.choice(shared)
                a = rnd.randrange(0, len(s) // 3)
                s = s[a: len(s) - rnd.randrange(0, len(s) // 3)]
                if rnd.random() < 0.3:
                    k = rnd.randrange(len(s))
                    s = s[:k] + "é" + s[k:]
                parts.append(s)
        rows.append((i, "".join(parts), "en", "a", 1))
    rows += [(100, "ab" * 900, "en", "a", 1), (101, "x" * 1000, "en", "a", 1), (102, ("line of text number one\n") * 60, "en", "a", 1),
             (103, shared[0] + letters(50), "en", "a", 1), (104, shared[0] + letters(50), "en", "a", 1),
             (105, "y" * 199, "en", "a", 1), (106, "y" * 200, "en", "a", 1), (107, "z" * 201, "en", "a", 1)]
    rows += [(110, rows[0][1], "en", "a", 1), (110, rows[0][1], "en", "a", 1)]
    return rows


@pytest.mark.parametrize("group_rows", [S.GROUP_ROWS, 3])
def test_as_by_brute_force(spark, group_rows):
    check(spark, passages(), group_rows)


def test_odd_rows_and_empty(spark):
    check(spark, odd_rows() + [(20, "\0" * 300 + "a", "en", "a", 1), (21, "\0" * 250, "en", "a", 1)])
    assert S.remove_repeats(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_suffix_order_is_that_of_plain_sorting():
    rnd = random.Random(8)
    strings = [bytes(rnd.choices(b"\0ab", k=rnd.randrange(40))) for _ in range(400)]
    strings += [b"a" * 30 + bytes(rnd.choices(b"ab", k=rnd.randrange(30))) for _ in range(200)]
    group = np.array([rnd.randrange(3) for _ in strings])
    order = S.suffix_order(group, strings, 0)
    want = sorted(range(len(strings)), key=lambda i: (group[i], strings[i]))
    assert [(group[i], strings[i]) for i in order] == [(group[i], strings[i]) for i in want]


@pytest.mark.parametrize("values", [2, 50, 2**63])
def test_multikey_quicksort(values):
    rng = np.random.default_rng(values % 97)
    for m in (0, 1, 2, 700):
        group = rng.integers(0, 5, m)
        keys = rng.integers(0, values, (2, m)).astype(np.uint64)
        order, equal = S.multikey_quicksort(group, keys)
        rows = list(zip(group.tolist(), keys[0].tolist(), keys[1].tolist()))
        got = [rows[i] for i in order.tolist()]
        assert sorted(order.tolist()) == list(range(m)) and got == sorted(rows)
        runs = [(i, j) for i, j in equal.tolist()]
        assert all(len(set(got[i:j])) == 1 and j - i > 1 for i, j in runs)
        assert sum(j - i for i, j in runs) == sum(n for n in map(rows.count, set(rows)) if n > 1)
