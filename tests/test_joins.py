import random

from conftest import rows
from helpers import T0, frame

from eventide.operators.joins import interval_join, pair_one_to_one
from eventide.plans import jobs


def _pays(spark, data):
    return frame(spark, "pay_id string, ts_s long, seq long", data)


def test_interval_join_inclusive_edges(spark):
    pays = _pays(spark, [("x", T0, 0), ("y", T0, 1)])
    rec = _pays(spark, [("x", T0 - 15, 10), ("x", T0 + 15, 11), ("x", T0 + 16, 12), ("y", T0 - 16, 13)])
    got = rows(jobs.receipt_interval_join(pays, rec), "pay_id", "pay_seq", "receipt_seq")
    assert got == [("x", 0, 10), ("x", 0, 11)]


def test_interval_join_buckets_equal_brute_force(spark):
    random.seed(21)
    left = [(random.choice("ab"), T0 + random.randint(0, 2000), i) for i in range(150)]
    right = [(random.choice("abc"), T0 + random.randint(0, 2000), 1000 + i) for i in range(150)]
    expect = sorted((l[2], r[2]) for l in left for r in right
                    if l[0] == r[0] and l[1] - 30 <= r[1] <= l[1] + 10)
    L, R = _pays(spark, left), _pays(spark, right)
    for bucket in (None, "auto", "40 seconds", "97 seconds"):
        got = rows(interval_join(L, R, "pay_id", "-30 seconds", "10 seconds", bucket=bucket),
                   "left_seq", "right_seq")
        assert got == expect, bucket


def _py_pairs(events, timeout=None):
    """Sequential statement of the pending-slot pairing (test oracle).
    events: (key, ts, seq, side) with side 0 = left, 1 = right."""
    matched, left_only, right_only, over = [], [], [], []
    state = {}
    by = {}
    for e in sorted(events, key=lambda e: (e[0], e[1], e[2], e[3])):
        by.setdefault(e[0], []).append(e)
    for k, evs in by.items():
        pend = None
        for e in evs:
            if pend is not None and timeout is not None and e[1] - pend[1] > timeout:
                (left_only if pend[3] == 0 else right_only).append(pend[2])
                pend = None
            if pend is None:
                pend = e
            elif pend[3] != e[3]:
                a, b = (pend, e) if pend[3] == 0 else (e, pend)
                matched.append((a[2], b[2]))
                pend = None
            else:
                over.append(pend[2])
                pend = e
        if pend is not None:
            (left_only if pend[3] == 0 else right_only).append(pend[2])
    return sorted(matched), sorted(left_only), sorted(right_only), sorted(over)


def _run(spark, events, timeout, bucket="1 hour"):
    L = _pays(spark, [(e[0], e[1], e[2]) for e in events if e[3] == 0])
    R = _pays(spark, [(e[0], e[1], e[2]) for e in events if e[3] == 1])
    res = pair_one_to_one(L, R, "pay_id", timeout=None if timeout is None else f"{timeout} seconds",
                          bucket=bucket)
    return (rows(res.matched, "left_seq", "right_seq"), [r[0] for r in rows(res.left_only, "left_seq")],
            [r[0] for r in rows(res.right_only, "right_seq")], [r[0] for r in rows(res.overwritten, "seq")])


def test_pairing_small_patterns(spark):
    # P P R -> first P overwritten; P R R -> last R unmatched; P R R P -> two pairs
    ev = [("a", T0, 0, 0), ("a", T0 + 1, 1, 0), ("a", T0 + 2, 2, 1),
          ("b", T0, 3, 0), ("b", T0 + 1, 4, 1), ("b", T0 + 2, 5, 1),
          ("c", T0, 6, 0), ("c", T0 + 1, 7, 1), ("c", T0 + 2, 8, 1), ("c", T0 + 3, 9, 0)]
    m, lo, ro, ov = _run(spark, ev, None)
    assert m == [(1, 2), (3, 4), (6, 7), (9, 8)]
    assert lo == [] and ro == [5] and ov == [0]


def test_pairing_equals_loop_random(spark):
    random.seed(4)
    for timeout in (None, 40):
        ev = [(random.choice("abcd"), T0 + random.randint(0, 600), i, random.randint(0, 1)) for i in range(300)]
        # same-second rows across sides exercise the (ts, seq, side) order
        ev += [(e[0], e[1], 1000 + e[2], 1 - e[3]) for e in ev[:20]]
        expect = _py_pairs(ev, timeout)
        for bucket in (None, "1 hour", "45 seconds", "7 seconds"):
            assert _run(spark, ev, timeout, bucket) == expect, (timeout, bucket)


def test_pairing_timeout_edge(spark):
    # gap exactly the timeout still pairs; one second more and the pay times out
    ev = [("a", T0, 0, 0), ("a", T0 + 5, 1, 1), ("b", T0, 2, 0), ("b", T0 + 6, 3, 1)]
    m, lo, ro, ov = _run(spark, ev, 5)
    assert m == [(0, 1)] and lo == [2] and ro == [3] and ov == []
