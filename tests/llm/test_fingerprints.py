import hashlib

import numpy as np

from eventide.llm import fingerprints as fp


def phrases(data):
    seen, at = set(), b""
    for i in range(len(data)):
        at += data[i:i + 1]
        if at not in seen:
            seen.add(at)
            at = b""
    return seen


def test_parse_is_lz78():
    for t in (b"", b"a", b"aaaaaaa", b"abababababcabc" * 9, "éèé ü".encode() * 20):
        p = fp.Parse().feed(t)
        assert len(p.hashes) - 1 == len(set(p.hashes[1:])) == len(phrases(t))
        cut = len(t) // 3
        assert fp.Parse().feed(t[:cut]).copy().feed(t[cut:]).hashes == p.hashes


def test_likeness_is_jaccard_while_small():
    a, b = b"the cat sat on the mat and the hat", b"the cat sat on the mat and the dog ran"
    x, y = phrases(a), phrases(b)
    got = fp.likeness(fp.Parse().feed(a).minima(), fp.Parse().feed(b).minima())
    assert abs(got - len(x & y) / len(x | y)) < 1e-12
    rng = np.random.default_rng(0)
    a = rng.integers(97, 105, 40_000).astype(np.uint8).tobytes()
    b = a[:30_000] + rng.integers(97, 105, 10_000).astype(np.uint8).tobytes()
    x, y = phrases(a), phrases(b)
    got = fp.likeness(fp.Parse().feed(a).minima(), fp.Parse().feed(b).minima())
    assert abs(got - len(x & y) / len(x | y)) < 0.15


def test_edits_over_any_ranges(spark, docs):
    texts = {i: "ab cd éf " * (i % 7) + str(i * i) * (i % 5) for i in range(0, 400, 3)}
    texts[9], texts[12] = None, ""
    rows = [(i, t) for i, t in texts.items()] + [(None, "no id")]
    got = {r["doc_id"]: r for r in fp.fingerprint_edits(docs(rows[::-1]).repartition(5)).collect()}
    assert len(got) == len(rows)
    order = [None, *sorted(texts)]
    for i, d in enumerate(order):
        t, n = ((texts[x] or "") if x is not None else "no id" for x in (d, order[(i + 1) % len(order)]))
        half = len(t) // 2
        edited = t[:len(t) - half] + n[:half]
        r = got[d]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, ed, nx = (fp.Parse().feed(x.encode()).minima() for x in (t, edited, n))
        assert r["fingerprint"] == own.astype(">u4").tobytes().hex()
        assert r["edited_fingerprint"] == ed.astype(">u4").tobytes().hex()
        assert r["near_edited"] == fp.likeness(own, ed) == fp.same(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == fp.likeness(own, nx)


def test_one_row_repeats_and_none(spark, docs):
    one = fp.fingerprint_edits(docs([(1, "abcabc")])).collect()
    assert [r["near_next"] for r in one] == [1.0]
    assert len(fp.fingerprint_edits(docs([(1, "x y"), (1, "x y"), (1, None)])).collect()) == 3
    assert fp.fingerprint_edits(docs([])).count() == 0
    extra = docs([(1, "abc")]).selectExpr("*", "1 AS part", "2 AS tail", "'x' AS fingerprint")
    assert fp.fingerprint_edits(extra).count() == 1
