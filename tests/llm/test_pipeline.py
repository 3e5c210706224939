import collections

from pyspark.sql import functions as F

import corpus_pipeline
from rillmark.llm import langid
from .test_jaccard import brute as near
from .test_linededup import distance


def run_stage(spark, name, docs, sf_dir=""):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)


def test_stages_over_the_smallest_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), f"test-{name}")
        assert docs.columns == columns
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now and now <= ids
        if name == "near_copies":
            rows = [(r.doc_id, r.text) for r in docs.collect()]
            assert all(i == c for i, _, c in near(rows, 5, 80))
        if name == "repeated_lines":
            lines = collections.Counter(x.strip() for r in docs.collect() for x in (r.text or "").split("\n") if x.strip())
            assert max(lines.values()) == 1
        ids = now
    out = corpus_pipeline.tokens(spark, docs, sf).collect()
    assert {r.doc_id for r in out} == ids and all(r.exact and r.n_tokens == len(r.ids) for r in out)


def test_stages_keep_clean_documents(spark, docs_of):
    words = "the cat and a dog went over to see what was in that box of theirs today".split()
    clean = [(i, " ".join(words[(i * k * k + 3 * i + k) % 16] + "x" * ((i + k) % 3) for k in range(40)), "en", "a") for i in range(60)]
    junk = [(100, None, "en", "a"), (101, "12345 !!", "en", "a"), (102, clean[3][1] + "z", "en", "a")]
    docs = docs_of(clean + junk)
    told = run_stage(spark, "language", docs)
    assert {r.doc_id for r in told.collect()} == {*range(60), 102}
    lines = run_stage(spark, "repeated_lines", told)
    texts = {r.doc_id: r.text for r in lines.collect()}
    apart = {i for i in range(60) if all(distance(clean[i][1], c[1]) > 2 for c in clean[:i])}
    assert apart <= set(texts) and 102 not in texts
    one = {r.doc_id for r in run_stage(spark, "near_copies", docs_of(clean + [(102, clean[3][1] + " z", "en", "a")])).collect()}
    assert one == {i for i, _, c in near([(i, t) for i, t, _, _ in clean] + [(102, clean[3][1] + " z")], 5, 80) if i == c}


NAMES = ("score", "ambiguous", "lang_pred", "_id", "_drop", "_size", "_lot", "_plan", "_times", "ident", "drop", "doc", "hash", "number",
         "first", "place", "ends", "h1", "ids_")


def test_columns_of_any_name_pass_through_every_stage(spark, docs_of):
    words = "the cat and a dog went over to see what was in that box of theirs today".split()
    rows = [(i, "\n".join(" ".join(words[(i * k * k + 3 * i + k + j) % 16] + "xy"[:(i + k) % 3] for k in range(14)) for j in range(3)), "en", "a")
            for i in range(40)]
    docs = docs_of(rows + [(50, rows[0][1], "en", "a")]).withColumns({c: F.col("doc_id") * 2 for c in NAMES})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, ""), f"names-{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *NAMES]
        wrong = " OR ".join(f"NOT (`{c}` <=> doc_id * 2)" for c in NAMES)
        assert docs.count() > 5 and docs.where(wrong).count() == 0


def test_repeated_and_null_ids(spark, docs_of):
    words = [f"word{k}" for k in range(60)]
    texts = [" ".join(words[k:k + 12]) for k in range(0, 60, 12)]
    rows = [(k, t, "en", "a") for k, t in enumerate(texts)] * 2 + [(None, texts[0], "en", "a")] * 2 + [(None, None, "en", "a")] * 2
    rows += [(0, "another text under the same number as one before it", "en", "a")]
    out = [(r.doc_id, r.text) for r in run_stage(spark, "near_copies", docs_of(rows)).collect()]
    assert sorted(out, key=repr) == sorted({(i, t) for i, t, _, _ in rows}, key=repr)  # one row of each document
    docs = docs_of(rows)
    for name in ("language", "repeated_lines", "mixture"):
        got = run_stage(spark, name, docs).collect()
        assert {(r.doc_id, r.text) for r in got} <= {(i, t) for i, t, _, _ in rows}


def test_empty_tables(spark, docs_of):
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []
    assert langid.UNKNOWN == "und"
