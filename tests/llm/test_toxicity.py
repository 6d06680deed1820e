import random
import zlib

import numpy as np
import pytest

from skein.llm import op13_toxicity as m
from tests.conftest import SF001
from tests.llm.helpers import docs, prose, rows_of

BAD = ["wretched", "filthy", "vermin", "rotten"]


def corpus(n, seed):
    r = random.Random(seed)
    out = []
    for k in range(n):
        own = prose(seed * 10_000 + k, r.randint(5, 120)).split()
        toxic = k % 3 == 0
        if toxic:
            for _ in range(1 + len(own) // 30):
                own.insert(r.randrange(len(own)), r.choice(BAD))
        out.append((k, " ".join(own), int(toxic)))
    return out


@pytest.fixture(scope="module")
def network():
    rows = corpus(300, 1)
    return m.fit([t for _, t, _ in rows], [y for *_, y in rows])


def test_windows_cover_every_token_and_overlap():
    for n in range(1, 200):
        starts = m.window_starts(n, 32)
        assert {t for s in starts for t in range(s, min(n, s + 32))} == set(range(n))
        assert starts == sorted(set(starts)) and all(b - a <= 16 for a, b in zip(starts, starts[1:]))
        assert n <= 32 or starts[-1] == n - 32


def test_gradients_equal_differences():
    r = np.random.default_rng(0)
    net = m.Network.new(6, 8, 8, 3, 4, 1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    vocabulary = [b"a", b"bb", b"ccc", b"dddd"]
    flat = r.integers(0, 4, 14)
    at, mask = m.tensors(flat, np.array([0, 6, 9]), np.array([6, 3, 5]))
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        logit, _ = net.forward(net.gates(net.inputs(net.parts(vocabulary))), at, mask)
        return float((np.log1p(np.exp(logit)) - y * logit).sum())

    _, g = net.gradients(vocabulary, at, mask, lambda logit: 1 / (1 + np.exp(-logit)) - y)
    for name, v in net.p.items():
        for place in list(np.ndindex(v.shape))[::max(1, v.size // 6)]:
            old, step = v[place], 1e-3
            v[place] = old + step
            up = loss()
            v[place] = old - step
            down = loss()
            v[place] = old
            assert abs((up - down) / (2 * step) - g[name][place]) < 2e-3, name


def test_held_out_accuracy(network):
    rows = corpus(200, 2)
    s = m.Scorer(network).scores([t for _, t, _ in rows])
    y = np.array([t for *_, t in rows])
    assert (s[y == 1] >= m.THRESHOLD).mean() > 0.9 and (s[y == 0] >= m.THRESHOLD).mean() < 0.05


def test_scores_are_the_highest_window_s(network):
    text = prose(5, 400) + " " + " ".join(BAD) + " " + prose(6, 20)
    own = m.tokens(text)
    alone = [m.Scorer(network).scores([b" ".join(own[s:s + 32]).decode()])[0] for s in m.window_starts(len(own), 32)]
    assert abs(max(alone) - m.Scorer(network).scores([prose(1, 50), text, "", prose(2, 3)])[1]) < 1e-5


def test_a_toxic_passage_at_the_end_of_a_long_text_counts(network):
    clean = prose(8, 30_000)
    low, high = m.Scorer(network).scores([clean, clean + " " + " ".join(BAD * 3)])
    assert high >= m.THRESHOLD > low


ODD = [(1, None), (2, ""), (3, "?! ..."), (4, "é" * 50_000), (5, "wretched filthy vermin"), (5, "wretched filthy vermin"),
       (None, "table garden"), (6, "x " * 20_000)]


def test_odd_rows(spark, network):
    got = rows_of(m.score(docs(spark, ODD), None, net=network), "doc_id", "held_out", "score", "predicted")
    assert len(got) == len(ODD)
    assert all(0 <= s <= 1 and p == int(s >= 0.7) for _, _, s, p in got)
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, h, *_ in got)
    twice = [r for r in got if r[0] == 5]
    assert twice[0] == twice[1] and twice[0][3] == 1
    assert len({s for i, _, s, _ in got if i in (1, 2, 3)}) == 1


def test_labels_decide_only_outside_the_held_out_fold(spark):
    rows = corpus(120, 3)
    d = docs(spark, [(i, t) for i, t, _ in rows])
    label = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, None), (None, 1), (3, 0)], "doc_id bigint, toxic int")
    drawn = m.sample(d, label)
    ids = {t: i for i, t, _ in rows}
    assert drawn and all(zlib.crc32(str(ids[t]).encode()) % 3 != 1 for t, _ in drawn)
    assert dict(drawn)[rows[3][1]] == 1 if zlib.crc32(b"3") % 3 != 1 else True
    few = m.sample(d, label, per_class=5)
    assert [y for _, y in few].count(0) == 5 == [y for _, y in few].count(1)
    same = docs(spark, [(i, "one text") for i in range(50)])
    assert len(m.sample(same, label)) == 2


def test_nothing_to_learn(spark):
    label = spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int")
    got = m.score(docs(spark, [(1, "a"), (2, "b")]), label)
    assert [r["score"] for r in got.collect()] == [0.5, 0.5]
    assert m.score(docs(spark, [(1, "a")]).limit(0), label).count() == 0


def test_query(spark):
    got = m.op13_toxicity(spark, SF001)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == spark.read.parquet(f"{SF001}/documents.parquet").count()
