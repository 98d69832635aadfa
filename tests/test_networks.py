"""Provider groups against union-find, code sets against counting, hub patients, nulls, empty tables."""

import random
from collections import Counter, defaultdict
from datetime import date
from itertools import combinations

import pytest

from claimwright.operators import communities, itemsets


def _roots(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    by_patient = defaultdict(list)
    for patient, provider in pairs:
        find(provider)
        by_patient[patient].append(provider)
    for seen in by_patient.values():
        for other in seen[1:]:
            a, b = sorted((find(seen[0]), find(other)))
            root[b] = a
    return {x: find(x) for x in list(root)}


def _check(spark, pairs, **settings):
    rows = [(p, q, "x") for p, q in pairs]
    claims = spark.createDataFrame(rows, "patient_id string, provider_id string, label string")
    got = {r.provider: r for r in communities.provider_groups(claims, **settings).collect()}
    counts = Counter((p, q) for p, q in pairs if p is not None and q is not None)
    tied = [pair for pair, n in counts.items() if n >= settings.get("min_claims", 1)]
    expected = _roots(tied)
    assert {k: r.group_id for k, r in got.items()} == expected
    for r in got.values():
        members = {q for q, g in expected.items() if g == r.group_id}
        inside = [pair for pair in tied if pair[1] in members]
        assert r.providers == len(members) and r.patients == len({p for p, _ in inside})
        assert r.claims == sum(counts[pair] for pair in inside)


@pytest.mark.parametrize("min_claims", [1, 2])
def test_groups_match_union_find(spark, min_claims):
    rng = random.Random(min_claims)
    pairs = [(f"p{rng.randrange(300):03}", f"q{rng.randrange(250):03}") for _ in range(220)]
    pairs += rng.sample(pairs, 150) + [(None, "q001"), (None, "q002"), ("p000", None), (None, None)] * 2
    _check(spark, pairs, min_claims=min_claims)


def test_long_chain_and_hub_patient(spark):
    names = [f"q{i:03}" for i in range(120)]
    random.Random(5).shuffle(names)
    chain = [pair for i, (a, b) in enumerate(zip(names, names[1:])) for pair in ((f"c{i}", a), (f"c{i}", b))]
    hub = [("hub", f"z{i:05}") for i in range(3000)]
    _check(spark, chain + hub, max_rounds=20)


def test_no_ties(spark):
    empty = spark.createDataFrame([], "patient_id string, provider_id string")
    assert communities.provider_groups(empty).count() == 0
    with pytest.raises(RuntimeError):
        rows = spark.createDataFrame([("a", "x"), ("a", "y")], empty.schema)
        communities.provider_groups(rows, max_rounds=1)


def test_sets_match_counting(spark):
    rng = random.Random(2)
    rows = [
        (f"p{rng.randrange(40)}", date(2000 + rng.randrange(3), 1 + rng.randrange(12), 3),
         rng.choice(["A", "B", "C", None]), rng.choice(["1", "2", "3", "4"]))
        for _ in range(400)
    ]
    rows += [(None, date(2000, 1, 1), "A", "1"), ("p1", None, "Z", "9")] + [("hub", date(2001, 5, 5), "A", "1")] * 500
    claims = spark.createDataFrame(rows, "patient_id string, service_date date, primary_diagnosis_code string, procedure_code string")
    held = defaultdict(set)
    for p, d, a, b in rows:
        if p and d:
            held[p, d.year] |= {c for c in (a, b) if c}
    counts = Counter(s for items in held.values() for n in (1, 2, 3) for s in combinations(sorted(items), n))
    baskets = itemsets.baskets(claims)
    assert baskets.count() == len(held)
    model = itemsets.fit(baskets, 0.1, 0.5)
    sets = itemsets.frequent_sets(model)
    frequent = {tuple(r["items"]): r.baskets for r in sets.collect()}
    assert frequent == {s: n for s, n in counts.items() if n >= 0.1 * len(held)}
    rules = {(tuple(r.antecedent), r.consequent): r for r in itemsets.code_rules(model).collect()}
    for s, n in frequent.items():
        for c in s if len(s) > 1 else ():
            rest = tuple(x for x in s if x != c)
            confidence = n / counts[rest]
            assert ((rest, c) in rules) == (confidence >= 0.5)
            if confidence >= 0.5:
                assert rules[rest, c].lift == pytest.approx(confidence * len(held) / counts[(c,)])
    got = {tuple(r["items"]): r.ratio for r in itemsets.unusual_sets(sets, len(held), 1.0).collect()}
    for s, n in frequent.items():
        expected = len(held)
        for c in s:
            expected *= counts[(c,)] / len(held)
        assert len(s) == 1 or n / expected > 1.0 or got[s] == pytest.approx(n / expected)


def test_no_baskets(spark):
    claims = spark.createDataFrame([], "patient_id string, service_date date, primary_diagnosis_code string, procedure_code string")
    model = itemsets.fit(itemsets.baskets(claims), 0.1)
    assert itemsets.frequent_sets(model).count() == 0
