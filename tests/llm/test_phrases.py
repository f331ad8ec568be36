"""Phrase collocations, against counting every phrase of a small table."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventide.llm import catalog, phrases

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain(rows, longest=5, least=100, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for j in range(i + 1, min(i + longest, len(words)) + 1):
                    counts[lang][tuple(words[i:j])] += 1
    out = []
    for lang, found in counts.items():
        frequent = {p: f for p, f in found.items() if f >= least}
        ranked = []
        for p, a in frequent.items():
            inside = any(len(q) > len(p) and 100 * f >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                         for q, f in frequent.items())
            if len(p) < 2 or inside:
                continue
            score, k = min((1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, totals[lang], -s)
                for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


def got(frame):
    assert frame.columns == list(COLUMNS)
    return sorted(tuple(r) for r in frame.collect())


def texts(rng, n, words, marks=" .,!?\n"):
    return ["".join(rng.choice(words) + rng.choice([" "] * 8 + list(marks)) for _ in range(rng.randint(0, 30)))
            for _ in range(n)]


@pytest.mark.parametrize("shard_words", [10, 200, 1 << 19])
def test_like_counting_everything(spark, docs, shard_words):
    rng = random.Random(shard_words)
    rows = [(rng.choice(["en", "de", None, "und"]), t) for t in texts(rng, 120, ["A", "b", "c", "É", "é", "dd", "aa"])]
    rows += [("en", "one two three four five six\n" * 9), ("en", None), ("en", ""), (None, " \t ")]
    frame = docs([(i, t, lang) for i, (lang, t) in enumerate(rows)]).selectExpr("text", "lang", "1 AS n", "2 AS phrase").repartition(3)
    want = plain(rows, least=3, top=40)
    assert want and max(len(r[2].split()) for r in want) == 5
    assert got(phrases.collocations(frame, least=3, top=40, shard_words=shard_words)) == want


def test_one_word_repeated_and_long_pieces(spark, docs):
    rows = [("en", "x " * 3000 + "y z " * 500), ("en", "x x"), ("de", "q" * 200_000 + " q" * 40)]
    rows += [("fr", "a b\tc. " * 50)] * 2
    frame = docs([(1, t, lang) for lang, t in rows])
    for longest in (2, 5):
        assert got(phrases.collocations(frame, longest, least=30, shard_words=64)) == plain(rows, longest, least=30)


def test_ties_and_an_empty_table(spark, docs):
    rows = [("en", "b a. c a. É a. z a.\n" * 4)]
    frame = docs([(1, rows[0][1], "en")])
    assert got(phrases.collocations(frame, least=4, top=3)) == plain(rows, least=4, top=3)
    assert phrases.collocations(docs([])).count() == 0
    assert got(phrases.collocations(docs([(1, None, None), (2, "rare words", "en")]))) == []


def test_query_uses_production_values(spark, tmp_path):
    rng = random.Random(3)
    rows = [(lang, t) for lang in ("en", None) for t in texts(rng, 200, ["Go", "to", "the", "sea", "now"])]
    spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    assert got(catalog.op12_collocations(spark, str(tmp_path))) == plain(rows)


def test_scores_pass_64_bits(spark):
    big = 10**14 + 7
    row = spark.sql(f"SELECT (1000BD * CAST({big} AS DECIMAL(17, 0)) * CAST({3 * big} AS DECIMAL(17, 0))) "
                    f"DIV (CAST({big} AS DECIMAL(17, 0)) * CAST({big - 9} AS DECIMAL(17, 0))) AS s").first()
    assert row.s == 1000 * big * 3 * big // (big * (big - 9))


def test_colliding_digests_do_no_harm(spark, docs, monkeypatch):
    def coarse(lang, words, rows):
        return np.array([len(words[p[0] - 1]) % 2 for p in rows], np.int64)
    monkeypatch.setattr(phrases, "digests", coarse)
    rng = random.Random(9)
    rows = [("en", t) for t in texts(rng, 60, ["a", "bb", "cc", "d", "eee", "f"])]
    frame = docs([(1, t, lang) for lang, t in rows])
    assert got(phrases.collocations(frame, least=5, shard_words=100)) == plain(rows, least=5)


def test_index_steps_equal_counting():
    rng = np.random.default_rng(4)
    ids = phrases._squeeze(rng.integers(0, 4, 400))
    for width in (1, 2, 3, 4):
        grams = Counter(tuple(ids[i:i + width]) for i in range(len(ids) - width) if 0 not in ids[i:i + width])
        kept = sorted(g for g, f in grams.items() if f >= 3)
        sizes, owner, added, counts, covered = phrases.extensions(ids, np.array(kept), width)
        assert sizes.tolist() == [grams[g] for g in kept]
        have = {(*kept[o], a): c for o, a, c in zip(owner.tolist(), added.tolist(), counts.tolist())}
        want, cover = Counter(), np.zeros(len(ids), bool)
        for i in range(len(ids) - width - 1):
            gram = tuple(ids[i:i + width + 1])
            if gram[:-1] in kept and gram[1:] in kept:
                want[gram] += 1
                cover[i:i + width + 1] = True
        assert have == want and (covered == cover).all()


def test_index_of_many_ids():
    # ids times rows pass 32 bits
    ids = phrases._squeeze(np.concatenate([np.arange(1, 70_000), [0], np.arange(40_000, 70_000)])).astype(np.int32)
    for width in (2, 4):
        kept = np.array([range(i, i + width) for i in range(40_000, 70_000 - width)], np.int32)
        sizes, owner, added, counts, covered = phrases.extensions(ids, kept, width)
        assert (sizes == 2).all() and (counts == 2).all() and (added == kept[owner, -1] + 1).all()
        assert len(owner) == 30_000 - width - 1 and covered.sum() == 2 * (30_000 - 1)


def test_few_rows_for_many_phrases(spark, docs, tmp_path, monkeypatch):
    # what shards keep and send for the pruning is packed by ranges of digests, not one row or eight bytes a phrase
    kept = {}

    def stored(df, name, codec=None):
        df.write.parquet(str(tmp_path / name))
        kept[name] = spark.read.schema(df.schema).parquet(str(tmp_path / name))
        return kept[name]
    monkeypatch.setattr(phrases, "stored", stored)
    rng = random.Random(6)
    rows = [("en", " ".join(f"w{rng.randrange(300)}" for _ in range(20_000))) for _ in range(4)]
    frame = docs([(1, t, lang) for lang, t in rows]).coalesce(1)
    pairs = len({p for _, t in rows for p in zip(t.split(), t.split()[1:])})
    assert pairs > 45_000
    assert got(phrases.collocations(frame, 2, least=4)) == plain(rows, 2, least=4)
    level = kept["phrase-shards-1"]
    assert level.count() <= 3
    sent = level.where("digests IS NOT NULL").selectExpr("sum(octet_length(digests))").first()[0]
    assert sent < 3 * pairs


def test_ranges_and_shards_meet(spark, docs, monkeypatch):
    monkeypatch.setattr(phrases, "DEAL_BYTES", 100)
    rng = random.Random(8)
    rows = [(rng.choice(["en", "de"]), t) for t in texts(rng, 100, ["a", "bb", "cc", "d", "eee", "f"])]
    frame = docs([(1, t, lang) for lang, t in rows]).repartition(2)
    assert got(phrases.collocations(frame, least=5, shard_words=100)) == plain(rows, least=5)
    # counts above a byte, one of them only over all shards
    rows = [("en", "a b. " * 200)] * 3 + [("en", "a c. " * 250)]
    frame = docs([(1, t, lang) for lang, t in rows]).repartition(2)
    assert got(phrases.collocations(frame, least=300, shard_words=100)) == plain(rows, least=300)


def test_packed_forms_return():
    rng = np.random.default_rng(7)
    for width in (1, 2, 4):
        rows = rng.integers(1, 1 << 20, (500, width)).astype(np.int32)
        rows = rows[np.lexsort(rows.T[::-1])]
        assert (phrases._unpack_phrases(phrases._pack_phrases(rows), width) == rows).all()
    for bits in (1, 31, 63):
        named = np.sort(rng.integers(0, 1 << bits, 300, np.uint64))
        counts = rng.integers(1, 1000, 300)
        for least in (1, 100, 100_000):
            back, capped = phrases._unpack_digests(phrases._pack_digests(named, counts, least), least)
            assert (back == named).all() and (capped == np.minimum(counts, least)).all()
