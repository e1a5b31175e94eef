"""P15 over e-mail groups of three and more guests, against all pairs in plain Python."""
import random
from functools import lru_cache

from hostelry.plans import analyst

SCHEMA = "guest_id long, dedup_key string, name string, updated_at timestamp"


def _distance(a, b):
    @lru_cache(None)
    def d(i, j):
        if not i or not j:
            return i + j
        return min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
    return d(len(a), len(b))


def _wanted(rows):
    out = set()
    for g, k, a, _ in rows:
        for h, m, b, _ in rows:
            if k == m and g < h:
                d = _distance(a.lower(), b.lower())
                if d * 10 <= max(len(a), len(b)) * analyst.NAME_DISTANCE_TENTHS:
                    out.add((k, *sorted((a, b)), d))
    return out


def test_two_like_guests_who_both_differ_from_the_survivor(spark):
    import datetime as dt
    day = dt.datetime(2024, 1, 1)
    rows = [(1, "a@x", "Maria Fernandez", day), (2, "a@x", "Maria Fernandes", day), (3, "a@x", "Bob", dt.datetime(2024, 6, 1)),
            (4, "b@x", "Ann", day), (5, "c@x", "Ann", day), (5, "c@x", "Anna", day)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(r) for r in analyst.fuzzy_name_links(df).collect()] == [("a@x", "Maria Fernandes", "Maria Fernandez", 1)]
    assert {(r.guest_id, r.name) for r in analyst.fuzzy_name_members(df).collect()} == {(r[0], r[2]) for r in rows[:3]}


def test_links_are_all_pairs(spark):
    rng = random.Random(5)
    rows = []
    for key in range(6):
        known = ["", "a", "A", "Unknown", "\u0130\u0130\u0130 ab", "x" * 40]
        for _ in range(45):
            name = list(rng.choice(known)) if rng.random() < 0.8 else rng.choices("abcAB ", k=rng.randint(0, 24))
            for _ in range(rng.randint(0, 3)):
                at, how = rng.randint(0, len(name)), rng.randint(0, 2)
                name[at:at + (how > 0)] = [rng.choice("abcC")] if how < 2 else []
            known.append("".join(name))
            rows.append((rng.randint(1, 200), f"k{key}", known[-1], None))
    got = [tuple(r) for r in analyst.fuzzy_name_links(spark.createDataFrame(rows, SCHEMA)).collect()]
    want = _wanted(rows)
    assert len(want) > 200 and len(got) == len(set(got)) and set(got) == want


def test_chains_have_one_survivor(spark):
    import datetime as dt
    day = [dt.datetime(2024, 1, d) for d in range(1, 9)]
    chain = ["aaaaaaaaaa", "aaaaaaabbb", "aaaabbbbbb", "abbbbbbbbb", "bbbbbbbbbb"]  # each like its neighbours only
    rows = [(i, "a@x", n, day[i]) for i, n in enumerate(chain)] + [(7, "a@x", "zzzzzzzzzz", day[7]), (8, "b@x", "aaaaaaaaaa", day[0]), (9, "b@x", "aaaaaaaaaa", None)]
    got = {r.guest_id: r.identity_guest_id for r in analyst.guest_identities(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: 4, 1: 4, 2: 4, 3: 4, 4: 4, 7: 7, 8: 8, 9: 8}


def test_components_of_random_groups(spark):
    from hostelry.operators import identity
    rng = random.Random(6)
    links = [(g, rng.randrange(60), rng.randrange(60)) for g in "pq" for _ in range(45)] + [("r", i, i + 1) for i in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for g, a, b in links:
        lo, hi = sorted((find((g, a)), find((g, b))))
        root[hi] = lo
    got = identity.components(spark.createDataFrame(links, "g string, a long, b long"), "g", "a", "b").collect()
    assert {(r.g, r.node): r.root for r in got} == {x: find(x)[1] for x in list(root)} and len(got) == len(root)
