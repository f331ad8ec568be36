"""The array form of the model against a plain one, symbol by symbol."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventide.llm import ppm


def plain(train, depth):
    """Counts per context, as dictionaries."""
    seen = defaultdict(Counter)
    for t in train:
        x = bytes([ppm.START]) * depth + t + bytes([ppm.END])
        for i in range(depth, len(x)):
            for k in range(depth + 1):
                seen[x[i - k:i]][x[i]] += 1
    return seen


def probability(seen, ctx, symbol):
    p, out = 1.0, set()
    for k in range(len(ctx), -1, -1):
        here = seen.get(ctx[len(ctx) - k:])
        if here is None:
            continue
        left = {s: n for s, n in here.items() if s not in out}
        whole = sum(left.values()) + len(left)
        if symbol in left:
            return p * left[symbol] / whole
        if left:
            p *= len(left) / whole
        out |= set(here)
    return p / (ppm.SYMBOLS - len(out))


@pytest.mark.parametrize("depth", [2, 3, 5])
def test_scores_match_a_plain_model(depth):
    rnd = random.Random(depth)
    train = ["".join(rnd.choices("abcé ", k=rnd.randint(0, 40))).encode() for _ in range(60)]
    test = train[:5] + [b"", "zz top ü".encode(), b"abcabcabc", bytes(range(0, 200, 7))]
    seen = plain(train, depth)
    model = ppm.Model(*ppm.merge_counts([ppm.count_grams(train[:30], depth), ppm.count_grams(train[30:], depth)]),
                      depth)
    want = []
    for t in test:
        x = bytes([ppm.START]) * depth + t + bytes([ppm.END])
        want.append(sum(math.log(probability(seen, x[i - depth:i], x[i])) for i in range(depth, len(x))))
    assert np.allclose(model.score(test), want, rtol=1e-5, atol=1e-4)
    if depth == 2:
        assert np.allclose(ppm.dense_score([ppm.dense(model)], test)[:, 0], want, rtol=1e-5, atol=1e-4)


def test_probabilities_sum_to_one():
    train = [b"abracadabra", b"abba", b"cadabra abra"]
    model = ppm.Model(*ppm.count_grams(train, 2), 2)
    symbols = np.array([s for s in range(256) if s != ppm.START])
    for ctx in (b"ab", b"zz", b"ra", b"za", bytes([ppm.START] * 2)):
        code = (ctx[0] << 16 | ctx[1] << 8) | symbols
        assert abs(np.exp(model.values(code).astype(float)).sum() - 1) < 1e-5


def test_empty_model():
    model = ppm.Model(np.zeros(0, np.int64), np.zeros(0, np.int64), 3)
    assert np.allclose(model.score([b"", b"ab"]), [-math.log(255), -3 * math.log(255)], rtol=1e-5)


def test_code_map():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 20_000))
    m = ppm.CodeMap(keys)
    assert (m.find(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(np.arange(5000), keys)
    assert (m.find(other) == -1).all()
    assert (ppm.CodeMap(keys[:0]).find(keys) == -1).all()
