import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm.op4_pack import (
    ByteBpe,
    best_fit,
    bin_completion,
    fillings,
    least_sequences,
    op4_pack,
    pack,
    pieces,
    place_table,
    sequences,
    tokenizer_files,
)
from tests.conftest import SF001
from tests.llm.helpers import docs, prose


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_files()[0])


def test_ids_equal_the_tokenizer(whole):
    bpe = ByteBpe(*tokenizer_files())
    texts = ["", " ", "a", " a", "a ", "a  b", "a\nb", "a\n b", "\n\n", "it's don't 'll x's", "12 345a b6", "été Ñandú ß", "日本語 テキスト",
             "a b", "a  b", "x\x00y z", "<|endoftext|> <|im_end|>", "a<|endoftext|>", "<|endoftext", "x  <|endoftext|>\n<|endoftext|>", "### ... !!", "tab\there", "😀 emoji", "a\x1cb c", "İstanbul ǅ ɐ"]
    texts += [prose(i, 30) for i in range(20)]
    r = random.Random(4)
    texts += ["".join(r.choice("ab 1.\n\t'sé #") for _ in range(40)) for _ in range(300)]
    for t in texts:
        assert np.frombuffer(bpe.ids(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


def used(plan):
    out, n = {}, 0
    for times, own in plan:
        n += times
        for x in own:
            out[x] = out.get(x, 0) + times
    return out, n


def fewest(items, size):
    """Brute force: fewest sequences for a few pieces."""
    best = [len(items)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        for i, room in enumerate(rooms):
            if room >= items[k]:
                go(k + 1, rooms[:i] + [room - items[k]] + rooms[i + 1:])
        go(k + 1, [*rooms, size - items[k]])

    go(0, [])
    return best[0]


def test_solver_against_brute_force():
    r = random.Random(9)
    for _ in range(60):
        items = sorted((r.randint(1, 30) for _ in range(r.randint(1, 9))), reverse=True)
        counts = {x: items.count(x) for x in items}
        plan = bin_completion(counts, 30)
        assert used(plan)[0] == counts and all(sum(own) <= 30 for _, own in plan)
        assert least_sequences(counts, 30) <= used(plan)[1] == fewest(items, 30), items


def test_solver_on_many_pieces_is_near_the_volume_bound():
    r = random.Random(2)
    counts = {x: r.randint(1, 500) for x in range(1, 1024)}
    plan = bin_completion(counts, 1024)
    assert used(plan)[0] == counts
    assert used(plan)[1] <= used(best_fit(counts, 1024))[1]
    assert used(plan)[1] <= least_sequences(counts, 1024) * 1.001 + 1


def test_dominated_fillings_are_left_out():
    assert fillings({10: 1, 6: 1, 4: 1}, [4, 6, 10], 10) == [(10,)]
    got = fillings({7: 1, 6: 1, 4: 2, 3: 1}, [3, 4, 6, 7], 10)
    assert (7, 3) in got and (6, 4) in got and (4, 3) not in got


def test_places_are_unique():
    plan = [(3, (5, 5, 2)), (2, (5, 2, 2, 1)), (1, (2,))]
    t = place_table(plan)
    seen = set()
    for x, n in used(plan)[0].items():
        for rank in range(n):
            k = np.searchsorted(t["key"], (x << 44) + rank, side="right") - 1
            at = rank - t["rank"][k]
            place = (int(t["sequence"][k] + at // t["uses"][k]), int(t["offset"][k] + at % t["uses"][k] * x))
            assert place not in seen
            seen.add(place)
    assert len(seen) == 18


def check_packing(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_pieces_and_sequences(spark, whole):
    texts = {0: None, 1: "", 2: prose(1, 5), 3: prose(2, 400), 4: prose(3, 3000), 5: prose(1, 5)}
    d = docs(spark, [*texts.items(), (2, texts[2])])
    rows = pack(pieces(d, size=64, with_ids=True), size=64)
    got = rows.collect()
    n = check_packing(got, 64)
    assert n <= -(-sum(r.length for r in got) // 64) + 1
    for i, t in texts.items():
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        own = sorted((r for r in got if r.doc_id == i), key=lambda r: (r.piece, r.sequence_id))
        if i == 2:
            assert len(own) == 2 and own[0].sequence_id != own[1].sequence_id or own[0].offset != own[1].offset
            continue
        assert [x for r in own for x in r.ids] == ids
        assert all(r.length == 64 for r in own[1:]) and [r.piece for r in own] == list(range(len(own)))
        for r in own:
            part = np.array(ids[r.start:r.start + r.length], dtype="<u4")
            assert zlib.crc32(part.tobytes()) == r.ids_crc32
    whole_ids = sequences(rows).collect()
    assert len(whole_ids) == n and sum(len(r.ids) for r in whole_ids) == sum(r.length for r in got)


def test_empty_table_and_query(spark):
    assert pack(pieces(docs(spark, [(1, "a")]).limit(0))).count() == 0
    out = op4_pack(spark, SF001).collect()
    n = check_packing(out, 1024)
    assert n <= -(-sum(r.length for r in out) // 1024) * 1.02 + 1
    assert {r.doc_id for r in out} == {r.doc_id for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id").collect()}


def test_a_hot_length_fills_whole_sequences(spark):
    many = spark.range(0, 9000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"))
    out = pack(pieces(many)).collect()
    per = 1024 // out[0].length
    assert len(out) == 9000 and check_packing(out, 1024) == -(-9000 // per)


def test_limits_and_the_report_of_the_search():
    from skein.llm.op4_pack import Limits, search_report

    r = random.Random(8)
    for _ in range(20):
        counts = {r.randrange(1, 60): r.randrange(1, 5) for _ in range(12)}
        whole = search_report(counts, 60)
        cut = search_report(counts, 60, Limits(nodes=1, fillings=1, steps=1, dominance_items=0))
        assert whole["least"] <= whole["sequences"] <= whole["best_fit"] == cut["best_fit"]
        assert cut["sequences"] <= cut["best_fit"]
        assert whole["limited"] is False or whole["sequences"] > whole["least"]
        if cut["sequences"] > cut["least"]:
            assert cut["limited"] or whole["sequences"] == cut["sequences"] or whole["sequences"] < cut["sequences"]


def test_latin_texts_are_encoded_in_one_call(monkeypatch):
    bpe = ByteBpe(*tokenizer_files())
    calls = []
    encode = bpe._encode
    monkeypatch.setattr(bpe, "_encode", lambda part: calls.append(part) or encode(part))
    latin = ["Rare words: zqxv wvutq, élan Ångström ſ ɏ 12345678901.\nThe last line", "it's  two  blanks \t\n", " led by one"]
    other = "a word, слово and a “quote” \u0250 語"
    for text in [*latin, other]:
        ids = [int(x) for x in np.frombuffer(bpe.ids(text), "<u4")]
        assert ids == bpe.loaded.encode(text, add_special_tokens=False).ids
    assert calls[:3] == latin and "".join(calls[3:]) == other and len(calls) > 4
