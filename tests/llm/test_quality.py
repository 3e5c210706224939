import collections
import math
import re

import pytest
import xxhash

from rillmark.llm import queries, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = collections.defaultdict(list)
    for k in range(len(w) - 2):
        at[tuple(w[k:k + 3])].append(k)
    covered = {k + j for v in at.values() if len(v) > 1 for k in v for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, dup, len(covered), failed


def grams(text):
    w = [x.encode() for x in WORD.findall(text or "")]
    signed = lambda h: (h - (1 << 64) if h >> 63 else h) % quality.BUCKETS
    first = [xxhash.xxh64_intdigest(x, 42) for x in w]
    return [signed(h) for h in first] + [signed(xxhash.xxh64_intdigest(y, h)) for h, y in zip(first, w[1:], strict=False)]


def ratios(rows, trusted):
    raw, target = collections.Counter(), collections.Counter()
    for i, t in rows:
        raw.update(grams(t))
        if i in trusted:
            target.update(grams(t))
    n, m = sum(raw.values()) + quality.BUCKETS, sum(target.values()) + quality.BUCKETS
    weight = lambda b: round(1e6 * (math.log((target[b] + 1) / (raw[b] + 1)) + math.log(n / m)))
    return [sum(map(weight, g)) / (len(g) * 1e6) if (g := grams(t)) else 0.0 for _, t in rows]


def test_whole_table_as_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    want = {i: (*base(t), v) for (i, t), v in zip(rows, ratios(rows, {i for i, q in labels.items() if q == 1}), strict=True)}
    got = queries.op1_quality_rules(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:7] == want[r.doc_id][:6]
        assert r.llr == pytest.approx(want[r.doc_id][6], abs=1e-9)
        assert r.kept == (not r.base_failed and r.llr >= -0.035)
    told = [r.kept == (labels[r.doc_id] == 1) for r in got if not r.base_failed and r.doc_id in labels]
    assert sum(told) >= 0.95 * len(told)


def test_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (4, "a b c a b c"), (5, "a b c x\na b c x\n\n\na b c x"), (6, "a a a a"),
            (7, "w " * 60000), (8, "é|<>#" * 60), (9, "a b\x0bc\x85d e"), (9, "a b"), (None, "one two three"), (4, "a b c a b c")]
    docs = docs_of(rows).withColumnRenamed("source", "w")
    trusted = spark.createDataFrame([(4,), (4,), (None,), (77,)], "doc_id bigint")
    got = quality.quality(docs, trusted).collect()
    want = sorted(((i, *base(t), round(v, 9)) for (i, t), v in zip(rows, ratios(rows, {4}), strict=True)), key=repr)
    assert sorted(((*tuple(r)[:7], round(r.llr, 9)) for r in got), key=repr) == want
    plain = quality.quality(docs, trusted.where("false")).collect()
    assert {r.llr for r in plain} == {0.0}
    assert quality.quality(docs_of([]), trusted).collect() == []
