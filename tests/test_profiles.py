"""First-come uniqueness over two keys against a loop over the requests."""

import random

from rillmark.operators.profiles import new_profiles

SCHEMA = "at int, username string, email string, note string"


def one_by_one(rows, existing):
    names, mails = {u for u, _ in existing if u}, {m for _, m in existing if m}
    out = []
    for r in sorted(set(rows), key=lambda r: (r[0], [(x is not None, x) for x in r[1:]])):
        if r[1] in names or r[2] in mails:
            continue
        out.append(r)
        names |= {r[1]} - {None}
        mails |= {r[2]} - {None}
    return sorted(out, key=repr)


def got(spark, rows, existing=()):
    have = spark.createDataFrame(list(existing), "username string, email string")
    out = new_profiles(spark.createDataFrame(rows, SCHEMA), have, ["at"])
    assert out.columns == ["at", "username", "email", "note"]
    return sorted(map(tuple, out.collect()), key=repr)


def test_a_chain_of_clashes(spark):
    # b clashes with a, c with b only: b is refused, so c is free; and so on
    rows = [(1, "a", "m1", ""), (2, "a", "m2", ""), (3, "c", "m2", ""), (4, "c", "m4", ""), (5, "e", "m4", ""), (6, "e", "m1", "")]
    assert got(spark, rows) == one_by_one(rows, ()) == [rows[0], rows[2], rows[4]]


def test_random_requests_one_name_wanted_by_a_third(spark):
    r = random.Random(1)
    rows = [(r.randint(0, 40), "hot" if r.random() < 0.33 else f"u{r.randint(0, 40)}", r.choice([None, f"m{r.randint(0, 50)}"]), "x")
            for _ in range(200)] + [(1, None, "m1", "y"), (1, None, None, "y"), (1, None, None, "y"), (0, None, "m1", None)]
    existing = [("u3", "m7"), (None, "m8"), ("u5", None)]
    assert got(spark, rows, existing) == one_by_one(rows, existing)


def test_no_requests(spark):
    assert got(spark, []) == [] and got(spark, [(1, "a", "b", "")], [("a", None)]) == []
