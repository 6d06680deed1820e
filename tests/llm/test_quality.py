import random

from skein.llm import op1_divergence as D
from skein.llm.op1_divergence import (
    char_histogram,
    duplicate_lines,
    js_distance,
    keep_good,
    op1_divergence,
    quality_rules,
    repeated_window_words,
)
from tests.conftest import SF001
from tests.llm.helpers import docs, prose, rows_of

import numpy as np


def naive(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    base = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), base


def test_counts_equal_the_plain_definition(spark):
    r = random.Random(3)
    texts = [None, "", " \n\t", "a", "a b c a b c", "a a a a a a", "x\x1cy\x85z w \x0b\x0c q\n\nq\nq \nq"]
    texts += [" ".join(r.choice("ab#é|") for _ in range(r.randint(1, 90))) for _ in range(40)]
    texts += ["\n".join(r.choice(["l1 w", "l2", "", " "]) for _ in range(r.randint(1, 30))) for _ in range(20)]
    got = {x.doc_id: x for x in quality_rules(docs(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == naive(t), t
        assert not (g.base_failed and g.kept)


def test_junk_goes_and_prose_stays(spark):
    good = [(i, prose(i, 120 + i)) for i in range(150)]
    junk = [(1000, " ".join(w + "###" for w in prose(7, 200).split())),
            (1001, prose(8, 200).upper() + "!!"),
            (1002, " | ".join("".join(random.Random(i).sample("abcdefghijkl", 8)) for i in range(200)))]
    kept = {r.doc_id: r.kept for r in quality_rules(docs(spark, good + junk)).collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in junk)


def test_short_texts_are_not_judged_by_distance(spark):
    r = quality_rules(docs(spark, [(i, prose(i, 100)) for i in range(20)] + [(99, "### ###")])).where("doc_id = 99").first()
    assert r.js_chars is None and r.js_words is None and r.base_failed


def test_rows_are_kept_with_all_columns(spark):
    d = docs(spark, [(i, prose(i, 100), [None, "en", "xx"][i % 3]) for i in range(30)] + [(1, prose(1, 100)), (2, None), (3, "")])
    out = keep_good(d)
    assert out.columns == d.columns and out.schema == d.schema
    assert sorted(r.doc_id for r in out.collect()) == sorted([*range(30), 1])
    assert keep_good(d.limit(0)).count() == 0 and quality_rules(d.limit(0)).count() == 0


def test_distance_and_histogram():
    assert js_distance(np.array([1.0, 1]), np.array([2.0, 2])) == 0
    assert js_distance(np.array([1.0, 0]), np.array([0, 3.0])) == 1
    assert list(char_histogram("aB1 .#é\U0001F600")) == [2, 1, 0, 1, 1, 1, 1, 1]
    assert repeated_window_words([]) == 0 and duplicate_lines("") == 0


def test_query_on_the_table(spark):
    out = op1_divergence(spark, SF001)
    assert out.count() == 200 and len(rows_of(out, "doc_id")) == 200


def test_every_language_has_its_own_reference(spark, monkeypatch):
    kana = str.maketrans("abcdefghijklmnopqrstuvwxyz", "アイウエオカキクケコサシスセソタチツテトナニヌネノハ")
    rows = [(i, prose(i, 200), "en") for i in range(40)] + [(100 + i, prose(i, 120).translate(kana), "ja") for i in range(5)]
    rows += [(200 + i, prose(i, 130).translate(kana), "xx") for i in range(5)] + [(300, None, "zz"), (301, prose(1, 90), None)]
    want = rows_of(quality_rules(docs(spark, rows)), "doc_id", "n_words", "kept", "js_chars", "js_words")
    assert all(kept for i, _, kept, *_ in want if i < 300)
    monkeypatch.setattr(D, "MAX_LANGUAGES", 1)
    assert rows_of(quality_rules(docs(spark, rows)), "doc_id", "n_words", "kept", "js_chars", "js_words") == want
    assert sorted(r.doc_id for r in keep_good(docs(spark, rows)).collect() if r.doc_id < 300) == [r[0] for r in rows if r[0] < 300]
