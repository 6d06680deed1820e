import random

import numpy as np
import pytest

from skein.llm import op5_ngram_join as J
from skein.llm.components import components
from tests.conftest import SF001
from tests.llm.helpers import docs, prose


def brute(rows, width, percent):
    """component per id by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(i, set()).update([tuple(w)] if 0 < len(w) < width else zip(*(w[k:] for k in range(width))))
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                    x, y = sorted((root(a), root(b)))
                    comp[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited(text, n, seed):
    r = random.Random(seed)
    w = text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


def cases():
    rows, i = [], 0
    for g in range(12):  # groups at, above and below the threshold
        base = prose(100 + g, 60 + 25 * g)
        for k in range(6):
            rows.append((i, edited(base, k, i)))
            i += 1
    passage = prose(555, 60)
    for g in range(40):  # a passage that many otherwise different texts share
        rows.append((i, prose(900 + g, 50) + " " + passage))
        i += 1
    base = prose(7, 200)
    for g in range(60):  # one large group of near copies, two edits each
        rows.append((i, edited(base, g % 5, 5000 + g)))
        i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, "one"), (i + 3, "ONE"), (i + 4, "one two"), (i + 5, " \n")]
    rows += [(i + 6 + k, prose(100, 60)) for k in range(30)]  # exact copies
    return rows


@pytest.mark.parametrize("width,percent,common", [(3, 90, 16), (3, 90, 2), (5, 80, 16), (5, 80, 3), (3, 90, 1000)])
def test_components_equal_brute_force(spark, width, percent, common):
    rows = cases()
    got = J.near_duplicates(docs(spark, rows), width, percent, common=common).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, width, percent)


def proposed(spark, monkeypatch, rows, width, percent, **options):
    """(result, pairs proposed among the members of large groups)."""
    found = []
    whole = J.meetings

    def counted(*args):
        pairs, members = whole(*args)
        found.append(pairs.count())
        return pairs, members

    monkeypatch.setattr(J, "meetings", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in J.near_duplicates(docs(spark, rows), width, percent, **options).collect()}
    monkeypatch.undo()
    return got, sum(found)


def test_large_groups_cost_about_one_comparison_each(spark, monkeypatch):
    """Near copies at, above and below the threshold: no pairs but members with leaders."""
    base = prose(7, 150)
    rows = [(i, edited(base, 1 + i % 6, i)) for i in range(600)]
    got, pairs = proposed(spark, monkeypatch, rows, 3, 90)
    assert got == brute(rows, 3, 90)
    assert pairs <= 10 * len(rows)


def test_twice_the_group_takes_twice_the_pairs(spark, monkeypatch):
    base = prose(11, 60)
    rows = [(i, edited(base, 1 + i % 6, 7000 + i)) for i in range(1600)]
    small, few = proposed(spark, monkeypatch, rows[:800], 5, 80)
    large, more = proposed(spark, monkeypatch, rows, 5, 80)
    assert small == brute(rows[:800], 5, 80)
    assert more <= 2.2 * few + 100, (few, more)


def test_long_lists_become_groups_of_their_own(spark, monkeypatch):
    """Truncated, extended and edited copies, of which many lack the same shingles."""
    base = prose(21, 70).split()
    rows = []
    for i in range(240):
        r = random.Random(i)
        w = base[:len(base) - r.randrange(0, 40)] if i % 3 == 0 else base[r.randrange(0, 40):] if i % 3 == 1 else list(base)
        w = w + [f"tail{r.randrange(3)}-{k}" for k in range(r.randrange(0, 12))]
        if i % 4 == 0:
            w[r.randrange(len(w))] = f"x{r.randrange(50)}"
        rows.append((i, " ".join(w)))
    for width, percent, common in ((5, 80, 1), (3, 90, 4)):
        got, _ = proposed(spark, monkeypatch, rows, width, percent, common=common)
        assert got == brute(rows, width, percent), (width, percent, common)


def test_expensive_shingles_by_a_join(spark):
    rows = cases()
    got = J.near_duplicates(docs(spark, rows), 3, 90, bitmap_bytes=0).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 3, 90)


def test_rows_without_an_id_are_linked_with_nothing(spark):
    d = docs(spark, [(None, prose(1, 30)), (None, prose(1, 30)), (4, prose(1, 30)), (3, prose(1, 30)), (None, None)])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(d, 3, 90).collect()), key=repr)
    assert got == [(3, 28, 3), (4, 28, 3), (None, 0, None), (None, 28, None), (None, 28, None)]


def test_levels_keep_their_promise():
    r = np.random.default_rng(5)
    for _ in range(300):
        n = int(r.integers(1, 200))
        costly = r.random(J.stored(n, 90)) < r.choice([0.0, 0.3, 0.9, 1.0])
        level, need = J.choose_level(costly, n, 90, 2)
        spare = n - J.least_shared(n, 90)
        inside = costly[:spare + level]
        assert len(inside) == spare + level <= n
        assert need == 0 or need == level - inside.sum() >= 1


def test_repeated_rows_empty_table_and_query(spark):
    d = docs(spark, [(1, prose(1, 30)), (1, prose(1, 30)), (2, prose(1, 30)), (3, None), (3, None)])
    got = sorted((r.doc_id, r.component_id) for r in J.near_duplicates(d, 3, 90).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 3), (3, 3)]
    assert J.near_duplicates(d.limit(0), 3, 90).count() == 0
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.op5_ngram_join(spark, SF001).collect()}
    assert got == brute(rows, 3, 90)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(500, 400), (300, 400), (7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in range(100, 160))
    assert got[500] == got[400] == got[300] == 300
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_copies_meet_in_their_longest_list_only(spark):
    from skein.llm.op5_ngram_join import met

    r = random.Random(5)
    lists = {t: set(range(24)) - {r.randrange(24) for _ in range(t % 4)} for t in range(60)}
    lists |= {100 + t: set(r.sample(range(40), 6)) for t in range(30)}
    rows = [(1, t, -1, probe, bytes([x]), 100, x, bytes([x])) for t, xs in lists.items() for x in xs for probe in (False, True)]
    table = spark.createDataFrame(rows, "grp long, t long, band long, probe boolean, node binary, n long, f long, c binary")
    sizes = spark.createDataFrame([(1, t, -1, 2 * len(xs)) for t, xs in lists.items()], "grp long, t long, band long, k long")
    found = [(bytes(a), bytes(b)) for a, b in J.met(table, sizes, 80).collect()]
    every = [(bytes([x]), bytes([y])) for xs in lists.values() for x in xs for y in xs if x < y]
    assert set(found) == set(every)
    assert len(found) < 3 * len(set(every)) < len(every) / 4


def test_groups_within_another_add_nothing(spark):
    groups = {1: range(1, 7), 2: range(1, 5), 3: range(1, 7), 4: [9], 5: range(5, 8), 6: [5, 6]}
    members = spark.createDataFrame([(g, bytes([x])) for g, xs in groups.items() for x in xs], "grp long, node binary")
    got = {}
    for r in J.widest(members).collect():
        got.setdefault(r.grp, set()).add(r.node[0])
    assert got == {1: set(range(1, 7)), 5: {5, 6, 7}}


def test_shared_passages_take_a_few_rows_of_a_text(spark, monkeypatch):
    """Texts of one base and three of ten passages: not near copies, but each passage is in many of them."""
    from itertools import combinations

    base, passages = prose(31, 150), [" ".join(f"p{k}w{j}" for j in range(30)) for k in range(10)]
    rows = [(i, " ".join([base, *(passages[k] for k in ks)])) for i, ks in enumerate(combinations(range(10), 3))]
    rows += [(1000 + i, edited(t, 1, i)) for i, t in rows[::7]]
    taken, whole = [], J.cut

    def counted(df, tag):
        out = whole(df, tag)
        if tag == "join-met":
            taken.append(out.count())
        return out

    monkeypatch.setattr(J, "cut", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(docs(spark, rows), 3, 80).collect()}
    assert got == brute(rows, 3, 80)
    assert 0 < sum(taken) < 50 * len(rows), taken
