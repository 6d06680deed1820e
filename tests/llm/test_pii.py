import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from skein.llm import op9_pii as P
from tests.conftest import SF001
from tests.llm.helpers import docs


def plain(t):
    """The base rules as they are written."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        s = sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and s % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(6)
    texts = ["", "a@b.c", "@", "a@b", "a@@b.c", "a@b@c.d", "x.y@z-1.co.uk.", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.4", "1.2.3",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "5 4111111111111111", "+1 (017) 555-7713", "+1 2", "++123456789012", "é a@b.de 1.1.1.1"]
    for alphabet in ("a@.b", "0123456789. ", "12 -", "+1 ().-", "a1@. +-("):
        texts += ["".join(r.choice(alphabet) for _ in range(60)) for _ in range(300)]
    for t in texts:
        assert P.base_spans(t) == plain(t), repr(t)


def test_long_runs_take_linear_time():
    import time

    t0 = time.process_time()
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+" * 300_000, "1 " * 150_000, "@" * 300_000):
        P.base_spans(t)
        P.graph(t)
    assert time.process_time() - t0 < 30


def test_beliefs_are_exact_on_trees():
    r = np.random.default_rng(2)
    edges = np.array([[0, 1, 0], [1, 2, 1], [1, 3, 0], [3, 4, 1]])
    unary, pair = r.normal(size=(5, 3)), r.normal(size=(2, 3, 3))
    node, both = P.beliefs(unary, edges, pair, rounds=20, damp=0.0)
    want, joint, total = np.zeros((5, 3)), np.zeros((4, 3, 3)), 0.0
    for y in itertools.product(range(3), repeat=5):
        s = np.exp(sum(unary[i, y[i]] for i in range(5)) + sum(pair[t, y[i], y[j]] for i, j, t in edges))
        total += s
        for i in range(5):
            want[i, y[i]] += s
        for k, (i, j, _) in enumerate(edges):
            joint[k, y[i], y[j]] += s
    assert np.allclose(np.exp(node), want / total) and np.allclose(both, joint / total)


def make_text(r, hide=False):
    words = [r.choice("river stone cloud winter paper 2.0 4.0 12 1999".split()) for _ in range(60)]
    local, area = f"555-{r.randrange(10**4):04d}", f"({r.randrange(1000):03d})"
    words.insert(10, f"+1 {area} {local}")
    mail = f"{r.choice('abcdef')}{r.choice('xyz')}.{r.randrange(99)}"
    words.insert(30, f"{mail}@mail{r.randrange(9)}.example.com")
    words.insert(45, f"{r.randrange(1, 255)}.{r.randrange(255)}.{r.randrange(255)}.{r.randrange(255)}")
    if hide:
        words.insert(50, f"{area} {local}")
    return " ".join(words), local


@pytest.fixture(scope="module")
def field():
    r = random.Random(1)
    return P.fit([make_text(r, hide=False)[0] for _ in range(120)])


def test_the_field_learns_the_rules_and_finds_repeats(field):
    r = random.Random(77)
    hit = wrong = 0
    for _ in range(40):
        text, local = make_text(r, hide=True)
        base = P.base_spans(text)
        added = P.added_spans([text], [base], field, 0.9)[0]
        hit += any(text[s:e].endswith(local) and k == 3 for s, k, e in added)
        wrong += sum(not text[s:e].endswith(local) for s, k, e in added)
        assert not any(s < b and a < e for s, _, e in added for a, _, b in base)
    assert hit >= 30 and wrong <= 2


def test_clean_texts_stay_clean(field):
    texts = ["plain words only", "Version 2.0 of 1999, 12 pages; CC BY-NC 4.0.", "", "3 4 5 6"]
    assert P.added_spans(texts, [[] for _ in texts], field, 0.9) == [[], [], [], []]


def test_redaction(spark, field):
    rows = [(1, "mail a.b@c.de now"), (2, None), (3, ""), (4, "ip 1.2.3.4 and 1.2.3.4"), (4, "ip 1.2.3.4 and 1.2.3.4"), (5, "x" * 200_000 + " a@b.cd")]
    d = docs(spark, rows)
    out = P.redact(d, field)
    assert out.schema == d.schema
    got = sorted((r.doc_id, r.text) for r in out.collect() if r.text is not None and r.doc_id < 5)
    assert got == [(1, "mail [email] now"), (3, ""), (4, "ip [ip] and [ip]"), (4, "ip [ip] and [ip]")]
    assert P.redact_text("abcdef", [(1, 0, 4), (2, 1, 5)]) == "a[email]f"
    assert P.find(d.limit(0), field).count() == 0 and P.train_field(d.limit(0)).unary.shape == (P.FEATURES, P.LABELS)


def test_query_on_the_table(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    out = P.op9_pii(spark, SF001).collect()
    assert len(out) == len(texts)
    for r in out:
        base = plain(texts[r.doc_id])
        text = ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [sum(k == j for _, k, _ in base) for j in range(4)] == [r.n_email, r.n_ip, r.n_card, r.n_phone]
        every = [x for x in r.spans.split(",") if x]
        assert set(text.split(",")) - {""} <= set(every) and len(every) == len(base) + r.n_added
        starts = [(int(x.split(":")[1]), P.KINDS.index(x.split(":")[0])) for x in every]
        assert starts == sorted(starts)


def test_evidence_reaches_the_fiftieth_repeat():
    """A number given once, then cut short 50 times, by a field that knows agreement alone."""
    pair = np.zeros((1 + P.SKIPS, P.LABELS, P.LABELS))
    pair[1:] = 12.0 * np.eye(P.LABELS)
    unary = np.zeros((P.FEATURES, P.LABELS))
    for at in (0, 25, 50):
        words = ["call 0175557713 soon"] * 51
        words[at] = "call +10175557713 soon"
        text = " ".join(words)
        base = P.base_spans(text)
        added = P.added_spans([text], [base], P.Field(unary, pair), 0.95)[0]
        assert len(base) == 1 and [k for _, k, _ in added] == [3] * 50


def test_settled_beliefs_are_exact_on_a_long_chain():
    r = np.random.default_rng(5)
    n = 60
    edges = np.array([[i, i + 1, 0] for i in range(n - 1)])
    unary, pair = np.zeros((n, 3)), 6.0 * np.eye(3)[None] + r.normal(size=(1, 3, 3)) / 100
    unary[0, 1] = 30
    left, right = [unary[0]], [np.zeros(3)]
    for i in range(1, n):
        left.append(unary[i] + np.logaddexp.reduce(left[-1][:, None] + pair[0], 0))
        right.append(np.logaddexp.reduce((right[-1] + unary[n - i])[None, :] + pair[0], 1))
    want = np.array(left) + np.array(right[::-1])
    want -= np.logaddexp.reduce(want, 1)[:, None]
    assert np.allclose(P.beliefs(unary, edges, pair, rounds=None)[0], want, atol=1e-2)


def test_training_texts_are_distinct_and_qualify_however_rare(spark, monkeypatch):
    rows = [(i, f"plain words only {i} words".replace(str(i), "x" * (i % 7))) for i in range(3000)]
    rows += [(5000 + i, "call +1 555 010 0199 now") for i in range(500)]
    rows += [(6000 + i, f"mail to user{i}@example.com or call +49 30 1234{i:04d}") for i in range(30)]
    seen = []
    monkeypatch.setattr(P, "fit", lambda texts: seen.append(texts))
    d = docs(spark, rows)
    P.train_field(d, train_docs=400)
    P.train_field(d, train_docs=10)
    P.train_field(d, train_docs=400, train_chars=10)
    assert len(seen[0]) == len(set(seen[0])) == 31 and len(seen[1]) == 10 and set(seen[1]) <= set(seen[0]) and seen[2] == []
