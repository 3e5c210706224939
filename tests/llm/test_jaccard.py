import itertools
import random

from rillmark.llm.components import components
from rillmark.llm.jaccard import jaccard_components


def brute(rows, n, percent):
    ids = [i for i, _ in rows if i is not None]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = []
    for i, text in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        runs = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
        if i is not None:
            sets.append((i, runs))
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        both = len(x & y)
        if both and 100 * both >= percent * (len(x) + len(y) - both):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return sorted((i, len(s), find(i)) for i, s in sets)


def got(df):
    return sorted(tuple(r) for r in df.collect() if r.doc_id is not None)


def variants(seed, groups=4, each=12, words=60):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(300)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocab) for _ in range(words)]
        for _ in range(each):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(w)))
    return rows


def test_same_components_as_brute_force(spark, docs_of):
    rows = variants(1)
    for n, percent, bits in ((3, 90, 20), (3, 80, 8), (5, 80, 20)):
        assert got(jaccard_components(docs_of(rows), n, percent, bits)) == brute(rows, n, percent)


def test_rounds_change_nothing(docs_of):
    rows = variants(2, groups=2)
    assert got(jaccard_components(docs_of(rows), 3, 80, rounds=0)) == brute(rows, 3, 80)


def test_odd_rows(docs_of):
    long_text = " ".join("x%d" % i for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "two one"), (None, "one two"), (7, long_text),
            (8, long_text + " y"), (9, "\u00c4 b c d"), (10, "\u00e4 b c d"), (11, "a b c d"), (11, "one two"), (12, "A B C D")]
    out = jaccard_components(docs_of(rows).withColumnRenamed("source", "gram"), 3, 90)
    assert out.count() == len(rows)
    assert got(out) == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 29998, 7), (8, 29999, 7),
                               (9, 2, 9), (10, 2, 10), (11, 2, 4), (11, 1, 4), (12, 2, 4)])
    assert [r.component_id for r in out.collect() if r.doc_id is None] == [4]


def test_empty_table(docs_of):
    assert jaccard_components(docs_of([])).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(100, i) for i in range(101, 180)] + [(7, 7), (None, 3), (5, None)]
    out = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert out == {**{i: 20 for i in range(20, 61)}, **{i: 100 for i in range(100, 180)}}
