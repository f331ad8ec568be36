import math
import random
from collections import Counter

from eventide.llm import lm, ppm


def check(got, rows, train, depth=5):
    counts = Counter()
    for t in train:
        counts.update((t or "").encode().lower().split())
        counts["end"] += 1
    total, kinds = sum(counts.values()), len(counts)
    texts = [(t or "").encode().lower() for t in train]
    model = ppm.Model(*ppm.count_grams(texts, depth), depth) if texts else None
    for (i, t), r in zip(rows, got):
        tokens = (t or "").encode().lower().split() + ["end"]
        assert r["n_tokens"] == len(tokens) and r["train_tokens"] == total
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens)
        want = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens)
        assert abs(r["base_score"] - want) < 1e-6 * max(1, abs(want))
        if model:
            want = model.score([(t or "").encode().lower()])[0] / math.log(10)
            assert abs(r["score"] - want) < 1e-4 * max(1, abs(want))


def test_scores_and_base(spark, docs):
    rnd = random.Random(3)
    vocab = ["".join(rnd.choices("abcdeé", k=rnd.randint(1, 6))) for _ in range(300)]
    texts = [" ".join(rnd.choices(vocab, k=rnd.randint(0, 60))) for _ in range(120)] + [None, "", "a b c\td", "x"]
    train, rows = texts[:80] + texts[-4:], list(enumerate(texts + texts[:3]))
    frame = docs(rows).selectExpr("*", "1 AS code", "2 AS n")
    for frequent in (0, 10, 1000):
        got = lm.score(frame, lm.fit(docs(list(enumerate(train))), frequent=frequent)).orderBy("doc_id").collect()
        check(got, rows, train)
        assert len(got) == len(rows)


def test_depth_follows_the_node_limit(spark, docs):
    rnd = random.Random(4)
    train = ["".join(rnd.choices("abcdef ", k=200)) for _ in range(20)]
    fitted = lm.fit(docs(list(enumerate(train))), max_nodes=400)
    assert fitted.frozen.depth == 2
    rows = [(1, train[0]), (2, "zzz")]
    check(lm.score(docs(rows), fitted).orderBy("doc_id").collect(), rows, train, 2)


def test_depth_is_the_same_at_any_size(spark, docs):
    rnd = random.Random(5)
    train = ["".join(rnd.choices("abcdeé ", k=rnd.randint(0, 200))) for _ in range(60)] + [None, ""]
    rows = list(enumerate([*train[:20], "zzz top", "abcabc", "", None, "a" * 300, train[0]]))
    table, frame = docs(list(enumerate(train))), docs(rows)
    nodes = len(ppm.count_grams([(t or "").encode() for t in train], 5)[0])
    for shipped in (0, 50, nodes // 3, nodes - 1, nodes):       # all joined, some sent, all sent
        fitted = lm.fit(table, shipped=shipped)
        assert fitted.depth == 5 and (fitted.grams is None) == (shipped == nodes)
        assert fitted.near is None or len(fitted.near[0]) <= shipped
        check(lm.score(frame, fitted).orderBy("doc_id").collect(), rows, train)


def test_parts_of_a_trie_are_valued_in_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 16)
    rnd = random.Random(6)
    train = ["".join(rnd.choices("abcd ", k=100)) for _ in range(30)]
    rows = list(enumerate([*train[:5], "dcba abcd zz"]))
    check(lm.score(docs(rows), lm.fit(docs(list(enumerate(train))), shipped=20)).orderBy("doc_id").collect(), rows, train)


def test_nothing_to_learn_from(spark, docs):
    fitted = lm.fit(docs([]))
    check(lm.score(docs([(1, "a b"), (2, None)]), fitted).orderBy("doc_id").collect(), [(1, "a b"), (2, None)], [])
    assert lm.score(docs([]), fitted).count() == 0
