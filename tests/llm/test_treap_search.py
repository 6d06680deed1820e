import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from skein.llm import op11_treap_search as m
from tests.llm.helpers import docs, prose, rows_of

RUN = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return RUN.findall((text or "").translate(LOWER))


def brute(rows, items, k=50):
    """The contract read literally: (item_id, rank, doc_id, score)."""
    held = [(i, Counter(words(t))) for i, t in rows]
    n_docs = sum(bool(c) for _, c in held)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(words(t))
    out = []
    for item, own in asked.items():
        found = []
        for doc_id, c in held:
            mm = 100 - 50 + (50 * sum(c.values()) * n_docs) // total if total else 0
            score = sum(int(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))) * (
                (1_000_000_000 * c[t]) // (1000 * c[t] + 20 * mm)) for t in own if c[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (s, _, _, doc_id) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1):
            out.append((item, rank, doc_id, -s))
    return sorted(out, key=repr)


def run(spark, rows, items, k=50, n_docs=None, **index):
    d = docs(spark, rows)
    n, total = m.corpus_size(d)
    return rows_of(m.search(m.build_index(d, max(1, n), max(1, total), **index), spark.createDataFrame(
        items, "item_id bigint, text string"), max(1, n), k), "item_id", "rank", "doc_id", "score")


ROWS = [(k, prose(k, 3 + k % 40)) for k in range(120)] + [
    (200, None), (201, ""), (202, "!?"), (203, "Río é東京 été ÉTÉ Alpha-ALPHA_alpha"), (204, "0 a1 1a"),
    (None, "alpha beta"), (None, "alpha beta"), (7, "alpha beta"), (7, "alpha beta"),
    (300, prose(9, 3000))] + [(400 + k, "gamma gamma delta") for k in range(70)]
ITEMS = [(1, "Alpha beta?"), (2, "gamma, DELTA; rivers unknownword"), (3, ""), (4, None), (5, "nothing-of this"),
         (6, "été 東京 1a"), (None, "silver tables"), (7, "stone"), (7, "cloud"), (8, prose(5, 60))]


@pytest.mark.parametrize("index", [{}, {"block_docs": 1}, {"block_docs": 16}, {"block_terms": 10}])
def test_search_equals_brute_force(spark, index):
    assert run(spark, ROWS, ITEMS, **index) == brute(ROWS, ITEMS)


def test_ties_and_short_lists(spark):
    got = run(spark, ROWS, [(2, "gamma delta")], k=5)
    assert got == brute(ROWS, [(2, "gamma delta")], k=5)
    assert len(run(spark, [(1, "x"), (2, "y")], [(1, "x")])) == 1


def test_items_in_chunks(spark):
    d = docs(spark, ROWS)
    n, total = m.corpus_size(d)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = rows_of(m.search(m.build_index(d, n, total), items, n, chunk_terms=12), "item_id", "rank", "doc_id", "score")
    assert got == brute(ROWS, ITEMS)


def test_empty_tables(spark):
    d = docs(spark, ROWS)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert run(spark, [(1, None)], ITEMS) == []
    assert m.search(m.build_index(d, 10, 10), none, 10).count() == 0
    assert m.search(m.build_index(d.limit(0), 1, 1), spark.createDataFrame(ITEMS, none.schema), 1).collect() == []


@pytest.mark.parametrize("shape", [(1, 1), (1, 8), (9, 1), (70, 5), (5, 70), (64, 64)])
def test_treap_holds_every_cell_and_maximum(shape):
    r = np.random.default_rng(sum(shape))
    grid = r.integers(0, 50, shape) * (r.random(shape) < 0.3)
    grid[0, 0] = 7
    rows, cols = np.nonzero(grid)
    t = m.Treap.build(rows, cols, grid[rows, cols].astype(np.int64), *shape)
    again = m.Treap.from_falls(t.row_bits, t.col_bits, t.sizes, t.quarters, t.falls())
    assert (again.most == t.most).all() and t.most[0] == grid.max()
    assert sorted(t.most[-len(rows):].tolist()) == sorted(grid[rows, cols].tolist())
    child = t.children()
    for g in range(len(t.quarters)):
        n = bin(t.quarters[g]).count("1")
        assert t.most[child[g]:child[g] + n].max() == t.most[g]


def test_descent_leaves_most_cells_closed():
    n = 1024
    r = np.random.default_rng(3)
    # One term in all documents, weakly, but in eight of them strongly.
    impact = r.integers(1, 5, n)
    impact[100:108] = 1000
    t = m.Treap.build(np.zeros(n, np.int64), np.arange(n), impact.astype(np.int64), 1, n)
    best = m.Best(1, 8)
    opened = m.search_block(t, np.zeros(n, np.int64), np.arange(n), np.zeros(1, np.int64), np.zeros(1, np.int64),
                            np.ones(1, np.int64), best, width=2)
    assert sorted(best.id.tolist()) == list(range(100, 108)) and (best.score == 1000).all()
    assert opened < n // 8
