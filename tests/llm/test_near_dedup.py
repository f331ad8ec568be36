import random

import pytest

from eventide.llm import near_dedup as nd


def brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = tuple((t or "").encode().lower().split())
        sets[i] = {w[j:j + size] for j in range(max(1, len(w) - size + 1))} if w else set()
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, groups=12, loners=25):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = rnd.choices(vocab, k=rnd.randint(20, 120))
        for _ in range(rnd.randint(1, 7)):
            t = list(base)
            for _ in range(rnd.randint(0, 6)):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            rows.append(" ".join(t))
            base = t if rnd.random() < 0.5 else base      # chains
    rows += [" ".join(rnd.choices(vocab, k=rnd.randint(1, 60))) for _ in range(loners)]
    rows += ["one", "one", "ONE", "a b", "", None, " \t\n", "x y z " * 4000, "x y z " * 4001]
    rnd.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("size", [2, 5])
def test_components_match_brute_force(spark, docs, size):
    rows = corpus(size)
    frame = docs(rows).selectExpr("*", "1 AS id", "2 AS n", "'k' AS key", "0 AS component").repartition(3)
    got = nd.near_duplicates(frame, size=size).collect()
    want = brute(rows, size, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len(got) == len(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_hot_groups(spark, docs):
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    near = []
    for i in range(300):
        t = list(base)
        t[rnd.randrange(len(t))] = f"v{i}"
        near.append(" ".join(t))
    rows = list(enumerate(["same text of some words " * 5] * 400 + near))
    got = nd.near_duplicates(docs(rows), size=2).collect()
    assert {r["component_id"] for r in got} == {0, 400}
    assert sum(r["kept"] for r in got) == 2


def test_null_and_repeated_ids(spark, docs):
    rows = [(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "p q r s"), (2, "t u v w"), (3, "t u v w"), (4, "a b c")]
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in nd.near_duplicates(docs(rows), size=2).collect()),
                 key=str)
    assert got == sorted([(None, None, True), (1, 1, True), (1, 1, True), (2, 2, True), (2, 2, True), (3, 2, False),
                          (4, 1, False)], key=str)
    assert nd.near_duplicates(docs([]), size=2).count() == 0


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 200)] + [(500, 501), (7, 7), (700, 600), (600, 700)]
    random.Random(1).shuffle(links)
    got = {r["id"]: r["component"] for r in nd.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and got[501] == 500 and got[700] == 600
    assert nd.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_tasks_write(spark, docs, monkeypatch):
    """Many shuffle partitions do not become as many small files."""
    files = {}

    def counted(df, name, codec=None):
        out = nd_stored(df, name, codec)
        files.setdefault(name, []).append(len(out.inputFiles()))
        return out

    nd_stored = nd.stored
    monkeypatch.setattr(nd, "stored", counted)
    keys = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    rows = corpus(3, groups=60, loners=60)
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = nd.near_duplicates(docs(rows).repartition(3), size=2).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, 2, 80)
    cores = spark.sparkContext.defaultParallelism
    assert all(max(files[k]) <= cores for k in ("buckets", "links", "star")), files
    assert all(max(files[k]) <= 4 * cores for k in files), files
