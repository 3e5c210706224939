import collections
import random

from rillmark.llm.linededup import banded_distances, line_classes, probes, segments, without_repeated_lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


def edited(rng, s, most):
    s = list(s)
    for _ in range(rng.randrange(most + 1)):
        k, kind = rng.randrange(len(s) + 1), rng.randrange(3)
        s[k:k + (kind != 0)] = [rng.choice("abcdé ")] if kind < 2 else []
    return "".join(s)


def test_banded_distances_equal_plain_ones():
    rng = random.Random(3)
    for threshold in (0, 1, 2, 4):
        a, b = [], []
        for n in (0, 1, 2, 5, 30, 64, 65, 130):
            for _ in range(40):
                s = "".join(rng.choice("abcdé\U0001f600") for _ in range(n))
                a.append(s)
                b.append(edited(rng, s, 6))
        want = [distance(x, y) <= threshold for x, y in zip(a, b, strict=True)]
        assert banded_distances(a, b, threshold).tolist() == want


def test_probes_miss_no_pair():
    rng = random.Random(4)
    for threshold in (1, 2, 3):
        for _ in range(1500):
            s = "".join(rng.choice("ab") for _ in range(rng.randrange(4, 20)))
            t = edited(rng, s, threshold)
            if distance(s, t) <= threshold:
                s, t = sorted((s, t), key=len)
                own = {(len(s), k, s[a:a + z]) for k, (a, z) in enumerate(segments(len(s), threshold + 1))}
                assert own & {(m, k, t[a:a + z]) for m, k, a, z in probes(len(t), threshold)}


def brute(rows, threshold, least):
    lines = [(i, k, x.strip(" \t\n\v\f\r")) for i, t in rows if i is not None for k, x in enumerate((t or "").split("\n"))]
    lines = sorted(x for x in lines if x[2])
    root, first = {}, {}
    for i, k, x in lines:
        first.setdefault(x, (i, k))
    texts = list(first)
    root = {x: x for x in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = collections.Counter()
    for n, x in enumerate(texts):
        for y in texts[:n]:
            if min(len(x), len(y)) >= least and abs(len(x) - len(y)) <= threshold and distance(x, y) <= threshold:
                links[x] += 1
                links[y] += 1
                p, q = sorted((find(x), find(y)), key=first.get)
                root[q] = p
    return sorted((i, k, *first[find(x)], links[x], (i, k) == first[find(x)]) for i, k, x in lines)


def corpus():
    rng = random.Random(5)
    bases = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(8, 70))).strip() or "x" for _ in range(14)]
    return [(i, "\n".join(edited(rng, rng.choice(bases), 3) for _ in range(rng.randrange(1, 6)))) for i in range(60)]


def test_classes_as_brute_force(docs_of):
    rows = corpus()
    for threshold, least in ((2, 24), (1, 10)):
        got = sorted(tuple(r) for r in line_classes(docs_of(rows), threshold, least).collect())
        assert got == brute(rows, threshold, least)


def test_hot_line_and_odd_rows(docs_of):
    text = "the same opening line of very many documents"
    rows = [(i, f"{text}\nown line number {i} {'xyz' * i}") for i in range(200)]
    rows += [(900, None), (901, ""), (902, " \n\t"), (None, text), (903, "y" * 50000), (904, "y" * 50001), (905, "no\nno\nnow")]
    got = {(r.doc_id, r.line_no): r for r in line_classes(docs_of(rows)).collect()}
    assert len(got) == 405
    assert sum(r.kept for k, r in got.items() if k[1] == 0 and k[0] < 900) == 1
    assert (got[904, 0].class_doc_id, got[904, 0].links, got[904, 0].kept) == (903, 1, False)
    assert [got[905, k].kept for k in range(3)] == [True, False, True]
    docs = docs_of(rows).withColumnRenamed("source", "line")
    out = {r.doc_id: r for r in without_repeated_lines(docs).collect()}
    assert out[0].text == rows[0][1] and out[7].text == rows[7][1].split("\n")[1] and out[7].n_chars == len(out[7].text)
    assert {900, 901, 902, None} <= set(out) and 904 not in out and out[905].text == "no\nnow"
    assert without_repeated_lines(docs).columns == docs.columns


def test_repeated_rows_and_empty_table(docs_of):
    twice = docs_of([(1, "first line\nsecond line"), (1, "first line\nsecond line"), (2, "second line")])
    assert sorted(r.text for r in without_repeated_lines(twice).collect()) == ["first line\nsecond line"] * 2
    assert line_classes(docs_of([])).collect() == [] and without_repeated_lines(docs_of([])).collect() == []


def test_short_lines_meet_by_edits_that_follow_their_length(docs_of):
    rng = random.Random(6)
    bases = ["".join(rng.choice("abcdé ") for _ in range(n)).strip() or "x" for n in range(5, 19) for _ in range(2)]
    rows = [(i, "\n".join(edited(rng, rng.choice(bases), 2) for _ in range(4))) for i in range(60)]
    rows += [(100, "Are, is anwh reenen."), (101, "Are. Is anwh reenen."), (102, "Éonchan ou le."), (103, "Éonchan | le."),
             (104, "page one"), (105, "page ones"), (106, "page 1"), (107, "page 2")]
    lines = sorted((i, k, x.strip()) for i, t in rows for k, x in enumerate(t.split("\n")) if x.strip())
    first = {}
    for i, k, x in lines:
        first.setdefault(x, (i, k))
    texts, links, root = list(first), collections.Counter(), {x: x for x in first}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, x in enumerate(texts):
        for y in texts[:n]:
            m = min(len(x), len(y))
            if distance(x, y) <= (0 if m < 8 else 1 if m < 12 else 2):
                links[x] += 1
                links[y] += 1
                p, q = sorted((find(x), find(y)), key=first.get)
                root[q] = p
    want = [(i, k, *first[find(x)], links[x], (i, k) == first[find(x)]) for i, k, x in lines]
    got = sorted(tuple(r) for r in line_classes(docs_of(rows)).collect())
    assert got == want
    kept = {r[0]: r[5] for r in got if r[0] >= 100}
    assert kept[100] and not kept[101] and not kept[103] and not kept[105] and kept[106] and kept[107]
