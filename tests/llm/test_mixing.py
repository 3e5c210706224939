import collections

import pytest
from pyspark.sql import functions as F

from rillmark.llm.mixing import mix, mixed


def filled(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    """Targets by filling up, one round of sharing after another."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        whole = sum(w[s] for s in open_)
        full = {s for s in open_ if target[s] + left * w[s] / whole >= repeats * sizes[s]}
        if not full:
            for s in open_:
                target[s] += left * w[s] / whole
            break
        for s in full:
            left -= repeats * sizes[s] - target[s]
            target[s] = repeats * sizes[s]
        open_ -= full
    return target


def corpus():
    rows = []
    for s, n in (("a", 300), ("b", 900), ("c", 120), ("é", 60), (None, 200)):
        first = len(rows)
        rows += [(first + k, " ".join(["w"] * (1 + (k * 7919) % 23)), None, s) for k in range(n)]
    return rows


def repeated():
    """Five ids, each of many rows: some with texts of their own, some given several times."""
    rows = []
    for s, n in (("a", 300), ("b", 900), ("c", 120), ("é", 60), (None, 200)):
        rows += [(len(rows), " ".join(["w"] * (1 + (k * 7919) % 23)), None, s) for k in range(n)]
    return rows


def totals(rows):
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(t.split())
    return sizes


def test_targets_and_taken(docs_of):
    rows = corpus()
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(t.split())
    want, got = filled(sizes), mix(docs_of(rows)).collect()
    source = {i: s for i, _, _, s in rows}
    taken = collections.Counter()
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size) and r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    for s, target in want.items():
        assert abs(taken[s] - target) <= 2 * 23
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    assert sorted(map(tuple, mix(docs_of(rows[::-1]).repartition(5)).collect())) == sorted(map(tuple, got))


def test_documents_come_as_often_as_taken(docs_of):
    docs = docs_of(corpus()).withColumn("total", F.lit(1)).withColumn("_s", F.lit("x"))
    times = {r.doc_id: r.taken // r.size for r in mix(docs).collect()}
    out = mixed(docs)
    assert out.columns == docs.columns
    seen = collections.Counter(r.doc_id for r in out.collect())
    assert {i: seen[i] for i in times} == times


@pytest.mark.parametrize("weights,share,repeats", [((5, 2, 1), 1.5, 2), ((3, 1), 2.5, 3), ((1,), 1.0, 1), ((2, 1), 5.0, 2)])
def test_repeated_ids_meet_the_targets(docs_of, weights, share, repeats):
    rows = repeated()
    sizes, source = totals(rows), {i: s for i, _, _, s in rows}
    assert len(source) == 5
    want = filled(sizes, weights, share, repeats)
    got, taken = mix(docs_of(rows), weights, share, repeats).collect(), collections.Counter()
    for r in got:
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - t) <= 2 * 23 for s, t in want.items()), (taken, want)
    out = mixed(docs_of(rows), weights, share, repeats).collect()
    again = collections.Counter()
    for r in out:
        again[r.source] += len(r.text.split())
    assert again == +taken
    assert sorted(map(tuple, mix(docs_of(rows[::-1]).repartition(5), weights, share, repeats).collect())) == sorted(map(tuple, got))


def test_columns_of_any_name_pass_through(docs_of):
    docs = docs_of(corpus()).withColumns({c: F.col("doc_id") * 2 for c in (
        "_size", "_lot", "_times", "_plan", "_again", "place", "named", "ends", "again", "size", "target", "budget", "_s")})
    out = mixed(docs)
    assert out.columns == docs.columns
    assert out.where("_size <> doc_id * 2 OR place <> doc_id * 2 OR _plan <> doc_id * 2 OR ends <> doc_id * 2").count() == 0
    assert out.count() > 1000
    assert mix(docs).count() == docs.count()


def test_odd_rows(docs_of):
    rows = [(1, None, None, "a"), (2, "", None, None), (3, " \t", None, "b"), (None, "x y", None, "a"), (4, "x y", None, "a"),
            (4, "x y", None, "a"), (5, "z " * 100000, None, "a")]
    got = mix(docs_of(rows)).collect()
    assert len(got) == len(rows)
    assert all(r.taken == 0 for r in got if not r.size)
    assert {r.target for r in got if r.doc_id in (2, 3)} == {0.0}
    assert mix(docs_of([])).collect() == [] and mixed(docs_of([])).collect() == []
    assert [(r.target, r.taken) for r in mix(docs_of([(1, "", None, "a")])).collect()] == [(0.0, 0)]


def test_other_weights_shares_and_repeats(docs_of):
    rows = corpus()
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(t.split())
    source = {i: s for i, _, _, s in rows}
    for weights, share, repeats in (((1,), 0.5, 1), ((3, 1), 2.5, 3)):
        want = filled(sizes, weights, share, repeats)
        taken = collections.Counter()
        for r in mix(docs_of(rows), weights, share, repeats).collect():
            assert r.taken <= repeats * r.size
            taken[source[r.doc_id]] += r.taken
        assert all(abs(taken[s] - t) <= 2 * 23 for s, t in want.items()), (taken, want)
