import random

import numpy as np
from pyspark.sql import functions as F

from rillmark.llm import queries
from rillmark.llm.toxicity import Scorer, Term, TermAutomaton, _terms_of, fit, learn_lexicon, quoted, toxicity, train

from .test_linededup import distance


def test_automaton_as_plain_distances():
    rng = random.Random(7)
    for _ in range(25):
        texts = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(2, 8))) for _ in range(6)})
        terms = [Term(t, rng.random() < 0.3, rng.randrange(3), rng.randrange(1, 9) / 8) for t in texts]
        automaton = TermAutomaton(terms)
        for _ in range(60):
            word = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 9)))
            found = []
            for k, t in enumerate(terms):
                heads = [word[:n] for n in range(len(word) + 1)] if t.stem else [word]
                e = min(distance(t.text, h) for h in heads)
                if e <= t.edits:
                    found.append((e, -t.weight, k))
            got = automaton.match(word)
            assert (got and (got[1], -terms[got[0]].weight)) == (min(found)[:2] if found else None), (terms, word)


def test_quotation_windows():
    at = lambda text, word: quoted(text.split(), text.split().index(word))
    assert at('he wrote "you are scum" and left', "scum\"") and at("« quel idiot » dit-il", "idiot")
    assert at('she called him an "idiot', '"idiot')
    assert not at('you are scum and "nice" people', "scum") and not at('"fine" you scum said nobody', "scum")


def test_quoted_terms_count_apart_from_abuse():
    scorer = Scorer([Term("scum", False, 0, 1.0), Term("worthless", False, 2, 0.5)])
    assert scorer.features("you scum, w0rthles scum!")[0][:4].tolist() == [np.log1p(2), np.log1p(0.5), 0, 0]
    assert scorer.features('they wrote "what scum" today')[0][:4].tolist() == [0, 0, np.log1p(1), 0]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op3_toxicity(spark, sf).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 60 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)


def test_odd_rows(spark, docs_of):
    rows = [(i, ("filthy vermin " if i % 3 == 0 else "kind friend ") + f"word{i % 7} talk") for i in range(90)]
    rows += [(100, None), (101, ""), (102, "filthy vermim " * 9000), (103, "word1 talk"), (103, "filthy vermin"), (None, "filthy vermin")]
    docs = docs_of(rows).withColumnRenamed("source", "score")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(0, 0), (None, 1), (100, 1), (55, None), (999, 1)],
                                   "doc_id bigint, toxic int")
    out = toxicity(docs, train(docs, labels))
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "score", "predicted", "n_terms"]
    got = {(r.doc_id, (r.text or "")[:6]): r for r in out.collect()}
    assert out.count() == len(rows)
    assert [got[k].predicted for k in ((0, "filthy"), (1, "kind f"), (102, "filthy"), (103, "word1 "), (103, "filthy"), (None, "filthy"),
                                       (100, ""), (101, ""))] == [1, 0, 1, 0, 1, 1, 0, 0]
    none = toxicity(docs, train(docs, labels.where("false")))
    assert {r.predicted for r in none.collect()} == {0}
    assert toxicity(docs_of([]), train(docs_of([]), labels)).collect() == []


def test_one_class_only():
    assert fit(np.zeros((3, 5)), np.array([0, 0, 0]))[-1] < 0 < fit(np.zeros((3, 5)), np.array([1, 1, 1]))[-1]


def test_stems_are_the_beginnings_of_longer_words(spark):
    row = spark.createDataFrame([("an Alphabet beta",)], "text string").select(_terms_of(F.col("text"), (4, 5)).alias("x")).first()
    assert sorted(row.x) == ["alph*", "alpha*", "alphabet", "beta"]


def test_stems_with_modest_odds_are_weighted_terms(spark):
    ends = ["ab", "ec", "id", "of", "ug", "ah", "ej", "ik", "ol", "um", "an", "ep"]
    rng = random.Random(8)
    word = lambda: "vorm" + rng.choice(ends) + rng.choice(ends) + rng.choice(ends)
    rows = [(1, f"plain talk {word()} {word()} and {word()} here") for _ in range(60)]
    rows += [(0, f"plain talk and {word()} here" if k < 40 else "plain talk and more here") for k in range(240)]
    terms = learn_lexicon(spark.createDataFrame(rows, "toxic int, text string"))
    assert any(t.stem and t.text.startswith("vorm") for t in terms), terms  # 60 of 60 and 40 of 240
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, (y, _) in enumerate(rows)], "doc_id bigint, toxic int")
    model = train(docs, labels)
    new = spark.createDataFrame([(1, f"some {word()} talk {word()} of {word()} now"), (2, f"some {word()} talk of more now")],
                                "doc_id bigint, text string")
    assert {r.doc_id: r.predicted for r in toxicity(new, model).collect()} == {1: 1, 2: 0}


def test_rarer_words_with_higher_odds_stay_beside_their_stem(spark):
    rows = [(1, "talk " + ("vormaxul vormix" if k < 20 else "vormely" if k < 40 else "vormitz")) for k in range(60)] + [(1, "talk nothing")] * 60
    rows += [(0, "talk " + ("vormely" if k < 20 else "vormitz" if k < 40 else "more")) for k in range(240)]
    terms = {t.text + "*" * t.stem: t for t in learn_lexicon(spark.createDataFrame(rows, "toxic int, text string"))}
    assert "vorm*" in terms and any(t.startswith("vorma") and terms[t].weight > terms["vorm*"].weight for t in terms), terms
