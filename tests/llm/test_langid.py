import random

from eventide.llm import langid


def corpus(n, seed):
    rnd = random.Random(seed)
    parts = {"en": ["th", "ing", "er", "wh"], "fr": ["eau", "que", "é", "oi"], "es": ["ción", "os", "ñ", "ll"]}
    return [(i, " ".join("".join(rnd.choices(parts[x], k=2)) for _ in range(rnd.randint(3, 30))), x)
            for i, x in enumerate(rnd.choices(sorted(parts), k=n))]


def test_held_out_accuracy_and_edges(spark, docs):
    model = langid.fit(docs(corpus(200, 1) + [(900, None, "fr"), (901, "text", None)]))
    assert model.langs == ["en", "es", "fr"]
    rows = corpus(150, 2)
    odd = [(1000, None), (1001, ""), (1002, "12 34 !!"), (1003, "ering " * 30_000)]
    frame = docs(rows + odd).selectExpr("*", "'old' AS lang_pred", "0 AS score")
    got = {r["doc_id"]: r for r in langid.predict(frame, model).collect()}
    right = sum(got[i]["lang_pred"] == x for i, _, x in rows)
    assert right >= 0.97 * len(rows)
    assert all(0 < got[i]["score"] <= 1 for i, _, _ in rows)
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003]["lang_pred"] == "en"


def test_nothing_to_learn_from(spark, docs):
    model = langid.fit(docs([]))
    assert [r["lang_pred"] for r in langid.predict(docs([(1, "some text")]), model).collect()] == ["und"]
    assert langid.predict(docs([]), model).count() == 0
