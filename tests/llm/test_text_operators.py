"""Mixing, quality rules, line deduplication, site quality and piece coding on small tables."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from eventide.llm import line_dedup, mixing, quality_rules, sentencepiece, site_quality

W = re.compile(r"[^\x20\x09-\x0D]+")


def test_mixing_meets_targets(spark, docs):
    rows = [(i, "w " * (i % 37), None, f"s{i % 4}" if i % 5 else None) for i in range(600)]
    rows += [(9000 + i, "v " * 50, None, "tiny") for i in range(3)] + [(9100, None, None, "s1"), (1, "w " * 1, None, "s1")]
    frame = docs(rows).selectExpr("*", "1 AS size", "2 AS slot", "3 AS rank")
    got = mixing.taken(frame, block=16).collect()
    assert len(got) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    order = sorted(x for x in sizes if x) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, free, want = sum(sizes.values()), set(order), {}
    while True:             # share out, stop at the caps, share the rest again
        left = total - sum(want.values())
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            want |= {s: level * weight[s] for s in free}
            break
        want |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    for s in order:
        assert abs(target[s] - want[s]) < 1e-6 * total
        assert abs(taken[s] - want[s]) <= 32
    again = mixing.taken(frame.repartition(7), block=16).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.taken(docs([])).count() == 0


def test_mixing_small_sources(spark, docs):
    # sources of 1 to 10 blocks beside a large one
    rows = [(i, "w " * 20000, None, "big") for i in range(50)]
    rows += [(1000 + i, "w " * (4 + i), None, f"s{i:02d}" if i else None) for i in range(48)]
    got = mixing.taken(docs(rows), block=16).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert len(target) == 49 and {-(-round(t) // 16) for s, t in target.items() if s != "big"} >= set(range(1, 11))
    assert {s: taken[s] for s in target} == {s: round(t) for s, t in target.items()}


def test_quality_measures(spark, docs):
    texts = ["a b c a b c d", "x\ny\nx\n\n \nx y", "#a $b |", "", None, "one two", "a a a a a a", "é ü\té ü é ü",
             "p q r s p q r t p q", " lead and  trail \x0b"]
    got = {r["doc_id"]: r for r in quality_rules.judge(docs(list(enumerate(texts))), [0] * 16).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w, r = W.findall(t), got[i]
        lines = [x for x in t.split("\n") if W.search(x)]
        tri = Counter(zip(w, w[1:], w[2:]))
        hit = {j + k for j in range(len(w) - 2) if tri[tuple(w[j:j + 3])] > 1 for k in range(3)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)), t
        assert r["base_failed"] and not r["kept"]


def test_quality_ratio_separates(spark, docs):
    good = [(i, "the cat sat on the mat and saw a dog " * 6 + f"n{i}") for i in range(30)]
    bad = [(100 + i, "zz## qq%% kk$$ " * 40 + f"m{i} " + " ".join(f"j{i}x{j}" for j in range(200))) for i in range(10)]
    frame = docs(good + bad)
    ratios = quality_rules.fit(frame, spark.createDataFrame([(i,) for i in range(20)], "doc_id long"), buckets=1 << 12)
    got = {r["doc_id"]: r["rating"] for r in quality_rules.judge(frame, ratios).collect()}
    assert min(got[i] for i, _ in good) > 0 > max(got[i] for i, _ in bad)
    assert len(quality_rules.fit(docs([]), spark.createDataFrame([], "doc_id long"), buckets=8)) == 8


def test_quality_rules_hash_each_word_once(docs):
    rated = quality_rules.judge(docs([(0, "a b c d a b c")]), [0] * 16, 0.0, [0] * 16, 1.0)
    # a word, a pair, and the two pairs of a window
    assert rated._jdf.queryExecution().optimizedPlan().toString().count("xxhash64(") == 3


def test_quality_rules_refuse_toxic(spark, docs, tmp_path):
    from eventide.llm import catalog
    # toxic texts differ from the clean ones by one word; junk is refused at any share of the corpus
    rng = np.random.default_rng(5)
    text = lambda i: " ".join(f"w{x:03d}" for x in rng.integers(0, 300, 80)) + (" nasty" if i % 5 == 0 else " sunny")
    rows = [(i, text(i)) for i in range(500)]
    rows += [(1000 + i, " ".join(f"j{x:03d}" for x in rng.integers(0, 300, 80))) for i in range(60)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i % 5 == 0) or None) for i in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = catalog.op1_likelihood_rules(spark, str(tmp_path)).collect()
    kept = lambda part: np.mean([r["kept"] for r in got if part(r["doc_id"])])
    assert len(got) == len(rows)
    assert kept(lambda i: i < 500 and i % 5 == 0) < 0.05
    assert kept(lambda i: i < 500 and i % 5) > 0.9
    assert kept(lambda i: i >= 1000) == 0
    bare = quality_rules.learn(docs(rows), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert (bare.threshold, bare.toxic_cut) == (-np.inf, np.inf)


def test_line_dedup_keeps_first(spark, docs):
    line = "this very line has more than eight words in it"
    rows = [(3, f"a\n{line}\nb"), (1, f"{line.upper()}  \nown words"), (2, f"{line}\n{line}"), (4, "short one"),
            (5, None), (6, ""), (None, line), (2, f"{line}\n{line}")]
    frame = docs(rows).selectExpr("*", "1 AS unit", "'x' AS removed", "0 AS start")
    got = sorted(((r["doc_id"], r["text"], [tuple(x) for x in r["removed"]])
                  for r in line_dedup.remove_repeats(frame).collect()), key=str)
    n = len(line)
    two = (2, "", [(0, 0, n, 1), (1, n + 1, n, 1)])
    assert got == sorted([(3, "a\nb", [(1, 2, n, 1)]), (1, f"{line.upper()}  \nown words", []), two, two,
                          (4, "short one", []), (5, None, []), (6, "", []), (None, "", [(0, 0, n, 1)])], key=str)
    assert line_dedup.remove_repeats(docs([])).count() == 0


def test_line_dedup_inside_lines(spark, docs):
    rng = np.random.default_rng(11)
    some = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    own = [some(60) for _ in range(4)]
    shared = some(400)
    rows = [(i, " ".join([*own[i][:30], *shared, *own[i][30:]])) for i in range(3)]
    rows.append((3, " ".join([*own[3][:30], *shared[:200]]) + "\n" + " ".join([*shared[200:], *own[3][30:]])))
    got = {r["doc_id"]: r for r in line_dedup.remove_repeats(docs(rows)).collect()}
    assert got[0]["text"] == rows[0][1] and got[0]["n_removed"] == 0
    for i in (1, 2, 3):
        words = got[i]["text"].split()
        assert [w for w in words if w in own[i]] == own[i]
        assert len(words) - 60 < 130         # edges of the passage: before the first cut, after the last
        assert got[i]["n_removed"] == len(got[i]["removed"]) > 0
        text = rows[i][1]
        for r in got[i]["removed"]:
            assert r["first_doc_id"] == 0
            assert text[r["start"]:r["start"] + r["length"]] in " ".join(shared)
            assert text[:r["start"]].count("\n") == r["unit"]


def test_site_quality(spark, docs):
    from pyspark.sql import functions as F
    rows = [(i, ("good words in a row here " + f"w{i} ") * 5 if i % 3 else "## $$ || " * 10, "p", f"h{i % 6}") for i in range(90)]
    rows += [(500, None, None, None), (501, "", "p", "h1"), (0, rows[0][1], "p", "h0")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, good int")
    got = site_quality.rate(docs(rows), labels, F.col("source"), F.col("lang")).collect()
    assert len(got) == len(rows)
    assert all(r["kept"] == (r["doc_id"] % 3 > 0) for r in got if r["doc_id"] < 90)
    # h0 and h3 hold only bad documents
    post = {r["host"]: r["host_posterior"] for r in got}
    assert max(post["h0"], post["h3"]) < min(post[h] for h in ("h1", "h2", "h4", "h5"))
    empty = spark.createDataFrame([], "doc_id long, good int")
    assert site_quality.rate(docs(rows), empty, F.col("source"), F.col("lang")).count() == len(rows)
    assert site_quality.rate(docs([]), labels, F.col("source"), F.col("lang")).count() == 0


def test_site_quality_toxic(spark, docs, tmp_path):
    from eventide.llm import catalog
    from pyspark.sql import functions as F
    # toxic texts are of the same shape as the clean ones, and only some of them are labelled
    rng = np.random.default_rng(3)
    text = lambda i: " ".join(f"w{x:03d}" for x in rng.integers(0, 400, 60)) + (" nasty" if i % 4 == 0 else " sunny")
    rows = [(i, text(i), "p", f"h{i % 3}") for i in range(400)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i % 4 == 0) or None) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = catalog.op7_site_quality(spark, str(tmp_path)).withColumn("toxic", F.col("doc_id") % 4 == 0).collect()
    assert len(got) == len(rows)
    assert np.mean([r["kept"] for r in got if r["toxic"]]) < 0.1
    assert np.mean([r["kept"] for r in got if not r["toxic"]]) > 0.9


def test_site_quality_writes_few_files(spark, docs, monkeypatch):
    from pyspark.sql import functions as F
    made, store = {}, site_quality.stored

    def counted(df, name):
        out = store(df, name)
        made[name] = len(out.inputFiles())
        return out
    rows = [(i, f"w{i % 7} w{i % 5} good" if i % 3 else f"x{i % 4} # $", f"p{i % 2}", f"h{i % 6}") for i in range(300)]
    rows += [(700, None, None, None), (None, "a b", "p0", "h1"), (0, "x0 # $", "p0", "h0")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 6 == 0)) for i in range(200)] + [(5, None, None), (None, 1, 0)],
                                   "doc_id long, good int, toxic int")
    many = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in many}
    for k, v in many.items():
        spark.conf.set(k, v)
    try:
        with monkeypatch.context() as m:
            m.setattr(site_quality, "stored", counted)
            got = site_quality.rate(docs(rows), labels, F.col("source"), F.col("lang")).collect()
        moved = site_quality.rate(docs(rows), labels, F.col("source"), F.col("lang"), shipped_ids=10).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    # as many files as tasks read the documents, or as there are cores
    assert len(made) == 4 and max(made.values()) <= 4
    # the same rows whether the labels or the features move
    key = lambda r: str(r[:3])
    assert len(got) == len(moved) == len(rows)
    for a, b in zip(sorted(got, key=key), sorted(moved, key=key)):
        assert a[:3] == b[:3] and a["kept"] == b["kept"] and np.allclose(a[3:7], b[3:7], rtol=1e-6, atol=1e-9)


def plain_score(v, text):
    best = [0.0] + [-np.inf] * len(text)
    for i in range(len(text)):
        for n in range(1, min(v.longest, len(text) - i) + 1):
            s = v.pieces.get(text[i:i + n])
            if s or n == 1:
                best[i + n] = max(best[i + n], best[i] + (s[0] if s else v.unknown))
    return best[-1]


def score_of(v, ids):
    back = {i: s for s, i in v.pieces.values()}
    out, left = 0.0, b""
    for i in ids:
        if i in back:
            out += back[i]
            continue
        left += v.spell[i]
        try:
            left.decode()
        except UnicodeDecodeError:
            continue
        out, left = out + v.unknown, b""
    return out


def test_pieces_round_trip_and_best_score(spark, docs):
    texts = ["hello world", "", None, " a  b ", "naïve café\nüber\tx 你好 🙂", "x" * 700, "word " * 400, "ab" * 300 + " c",
             "        deep\n\n\n", "🙂" * 200, "mixed " + "q" * 90 + " z" * 150]
    v = sentencepiece.Vocabulary()
    frame = docs(list(enumerate(texts))).selectExpr("*", "1 AS key", "2 AS ids", "'m' AS body_text")
    for chunk in (1 << 15, 64, 16):
        got = {r["doc_id"]: r for r in sentencepiece.encode(frame, chunk=chunk).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            r = got[i]
            assert r["round_trip"] and r["n_pieces"] == len(r["ids"])
            assert sentencepiece.Coder(v).decode(r["ids"]) == (t or "")
            want = plain_score(v, sentencepiece.mark(t or ""))
            assert abs(score_of(v, r["ids"]) - want) < 1e-6, (chunk, t)
            assert (r["n_chunks"] > 1) == (len(t or "") > chunk - 1 and len(t or "") >= chunk)
    marked = sentencepiece.encode(docs([(1, "a\u2581b")])).first()
    assert not marked["round_trip"] and sentencepiece.Coder(v).decode(marked["ids"]) == "a b"
    out = sentencepiece.decode(sentencepiece.encode(docs([(1, "x y"), (2, None)]))).collect()
    assert [r["decoded"] for r in sorted(out)] == ["x y", ""]
    assert sentencepiece.encode(docs([])).count() == 0


def test_state_scan_by_blocks_equals_one_pass(spark):
    rng = np.random.default_rng(3)
    chain = {k: [np.where(rng.random((4, 4)) < 0.2, -np.inf, rng.integers(-9, 9, (4, 4)).astype(float))
                 for _ in range(n)] for k, n in ((1, 1), (2, 9), (3, 70))}
    for ms in chain.values():
        for m in ms:
            m[0, 0] = -20.0                     # a path always exists
    rows = spark.createDataFrame([(k, i, m.tobytes()) for k, ms in chain.items() for i, m in enumerate(ms)],
                                 "key long, chunk long, matrix binary")
    got = {(r["k"], r["c"]): (r["entry"], r["over"]) for r in sentencepiece.scan(rows, 4, 70, block=3).collect()}
    for k, ms in chain.items():
        ends = [got[k, i] for i in range(len(ms))]
        assert ends[0][0] == 0 and ends[-1][1] == 0
        assert all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
        best = np.array([0.0, *[-np.inf] * 3])
        for m in ms:
            best = (best[:, None] + m).max(axis=0)
        assert sum(m[e] for m, e in zip(ms, ends)) == best[0]


def test_words_coded_together_are_coded_as_alone():
    rnd = random.Random(9)
    coder = sentencepiece.Coder(sentencepiece.Vocabulary())
    words = [" " + "".join(rnd.choices("abcthe1é日😀\x00", k=rnd.randint(0, 80))) for _ in range(400)]
    words += ["\n", "x", " ", "   ", " " + "é" * 64, " " + "日" * 300]
    scores, counts, ids = coder.many(pa.array([w.encode() for w in words], pa.large_binary()))
    at = 0
    for w, s, n in zip(words, scores, counts):
        w = w.replace(" ", sentencepiece.SPACE)
        best, back = coder.steps(w, 0, len(w))
        assert s == best[-1] and ids[at:at + n].tolist() == coder.trace(w, 0, len(w), back)
        at += n
    assert at == len(ids)
    texts = ["the cat  sat\n\non a▁b", None, "", "日" * 100 + " x", " "]
    coded, same = coder.texts(pa.array(texts))
    assert [list(x) for x in coded.to_pylist()] == [list(coder.encode(t or "")) for t in texts] and same.all()
    assert [len(x) for x in coder.texts(pa.array([None, ""]))] == [2, 2]


def test_rating_and_repeats_by_hand(spark, docs):
    rnd = random.Random(12)
    texts = [None, "", " \n", "a", "a b", "a b c", "a b c a b c", "a a a a"]
    texts += [" ".join(rnd.choices("abcdefgh", k=rnd.randint(0, 30))) for _ in range(40)]
    split = [W.findall(t or "") for t in texts]
    grams = sorted({(w[i], w[i + 1] if i + 1 < len(w) else None) for w in split for i in range(len(w))} |
                   {(x, None) for w in split for x in w}, key=str)
    frame = spark.createDataFrame(grams, "a string, b string").selectExpr("a", "b", "if(b IS NULL, xxhash64(a), xxhash64(a, b)) AS h")
    hashed = {(r["a"], r["b"]): r["h"] for r in frame.collect()}
    for buckets in (64, 61):                # a power of two, and not
        ratios = [rnd.randint(-10**6, 10**6) for _ in range(buckets)]
        got = quality_rules.judge(docs(list(enumerate(texts))), ratios).orderBy("doc_id").collect()
        for w, r in zip(split, got):
            n_grams = [(x, None) for x in w] + list(zip(w, w[1:]))
            want = sum(ratios[hashed[g] % buckets] for g in n_grams) / max(len(n_grams), 1) / quality_rules.SCALE
            assert abs(r["rating"] - want) < 1e-12
            windows = Counter(zip(w, w[1:], w[2:]))
            inside = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
            assert r["n_repeat_words"] == len(inside)
    # texts without a repeated window are not sorted
    rows = docs([(0, "a b c d"), (1, "a b c a b c"), (2, "a")]).withColumn("w", quality_rules.words(quality_rules.F.col("text")))
    sorted_ = rows.select(quality_rules.windows(quality_rules.window_hashes(quality_rules.F.col("w"))).alias("s")).collect()
    assert [r["s"] is None for r in sorted_] == [True, False, True]
