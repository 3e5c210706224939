import numpy as np

from rillmark.llm import langid, queries
from rillmark.llm.common import fold


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = queries.op6_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert len(held) > 200
    right = sum(r.lang_pred == truth[r.doc_id] for r in held)
    assert right >= 0.99 * len(held), (right, len(held))
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.ambiguous for r in got) <= 0.01 * len(got)


def test_held_out_rows_teach_nothing(spark, docs_of):
    rows = [(k, "the cat and the dog" if k % 2 else "der hund und die katze", "en" if k % 2 else "de") for k in range(40)]
    docs = docs_of(rows).withColumn("h", fold("doc_id", 4))
    kept = docs.where("h <> 2")
    a = langid.fit(kept)
    b = langid.fit(kept.unionByName(docs.where("h = 2").withColumn("lang", docs.lang.substr(9, 1)).where("lang IS NULL")))
    assert a.langs == ["de", "en"] and np.array_equal(a.weights, b.weights)


def test_odd_rows(docs_of):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et la souris", "fr"), (3, "der hund und die katze", "de"), (4, None, "en"),
            (5, "", None), (6, "123 !?", "fr"), (7, "the dog " * 50000, None), (7, "the dog", None), (None, "die katze", None)]
    docs = docs_of(rows).withColumnRenamed("source", "score")
    out = langid.identify(docs, langid.fit(docs))
    got = {(r.doc_id, (r.text or "")[:9]): r for r in out.collect()}
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "lang_pred", "score", "ambiguous"]
    assert [got[k].lang_pred for k in ((4, ""), (5, ""), (6, "123 !?"))] == ["und"] * 3
    assert got[(7, "the dog t")].lang_pred == got[(7, "the dog")].lang_pred == "en" and got[(None, "die katze")].lang_pred == "de"
    none = langid.identify(docs, langid.fit(docs.where("false")))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}
    one = langid.identify(docs, langid.fit(docs.where("lang = 'en'")))
    assert {r.lang_pred for r in one.collect()} == {"en", "und"}
    assert langid.identify(docs.where("false"), langid.fit(docs)).collect() == []


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 12, 40):
        code = langid.codewords(n)
        apart = [(a != b).sum() for k, a in enumerate(code) for b in code[:k]]
        assert min(apart) >= (1 if n < 3 else 2 ** (n - 2) if n <= 7 else code.shape[1] // 5)
        assert np.all(np.abs(code.sum(0)) < n)


def test_one_wrong_bit_is_corrected():
    counts = np.random.default_rng(1).integers(1, 50, (5, langid.CELLS))
    model = langid.Model(list("abcde"), counts)
    for k, word in enumerate(model.code):
        for bit in range(len(word)):
            z = word * model.scale
            z[bit] *= -1
            best, _, vague = model.decode(z[None].astype(float))
            assert best[0] == k and not vague[0]
