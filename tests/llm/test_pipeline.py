import pytest

import corpus_pipeline as P
from skein.llm.common import table
from tests.conftest import SF001
from tests.llm.helpers import docs, prose
from tests.llm.test_pack import check_packing


def test_stages_and_registration():
    import __spark_entry__ as entry

    assert [n for n, _ in P.STAGES] == ["quality", "duplicates", "private", "mix", "pack"] and P.ORACLE_SQL is None
    names = list(entry.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}
    assert not set(entry.oracle_sql()) - set(names)


@pytest.fixture(scope="module")
def corpus(spark):
    base = prose(1, 200)
    words = base.split()
    near = " ".join([*words[:100], "changed", *words[101:]])
    rows = [(i, prose(i, 80 + i), "en", f"s{i % 3}") for i in range(10, 60)]
    rows += [(100, base), (101, base), (102, near), (103, base + " mail me.now@mail.example.com"), (104, None), (105, ""),
             (106, " ".join(w + "###" for w in prose(5, 150).split())), (107, "too short")]
    return docs(spark, rows)


def test_decisions_take_effect(spark, corpus):
    out = {}
    d = corpus
    for name, stage in P.STAGES:
        d = stage(spark, d, SF001).cache()
        out[name] = d
        if name != "pack":
            assert d.schema == corpus.schema
    ids = {n: {r.doc_id for r in x.collect()} for n, x in out.items()}
    assert ids["quality"] == {*range(10, 60), 100, 101, 102, 103}
    assert ids["duplicates"] == {*range(10, 60), 100}
    assert ids["private"] == ids["duplicates"] >= ids["mix"] == ids["pack"]
    texts = {r.doc_id: r for r in out["private"].collect()}
    assert all(r.n_chars == len(r.text) for r in texts.values())
    assert check_packing(out["pack"].collect(), 1024) > 0
    hidden = P.private(spark, out["quality"], SF001).where("doc_id = 103").first()
    assert "[email]" in hidden.text and "@" not in hidden.text


def test_run_equals_the_stages_by_hand(spark):
    d = table(spark, SF001, "documents")
    for _, stage in P.STAGES:
        d = stage(spark, d, SF001).cache()
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    got = P.run(spark, SF001)
    assert sorted(tuple(r[c] for c in key) for r in got.collect()) == sorted(tuple(r[c] for c in key) for r in d.collect())
    assert check_packing(got.collect(), 1024) > 0


def test_empty_table(spark, corpus):
    d = corpus.limit(0)
    for name, stage in P.STAGES:
        d = stage(spark, d, SF001)
        assert d.count() == 0, name
