import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from skein.llm.op4_pack import tokenizer_files
from skein.llm.op12_align import (
    Pair, PairTable, _byte_letters, align, bucket_of, build_hash, op12_align, piece_file,
)
from tests.conftest import SF001
from tests.llm.helpers import docs, rows_of

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def plain():
    """Both tokenizers as their libraries load them, and the bytes of their tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_files()[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=piece_file())
    letters = _byte_letters()
    assert sorted(letters.values()) == list(range(256))

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        whole = (" " + text).encode()
        ta = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        tb = [(i, bytes_b(i)) for i in b.encode(text)]
        same = b"".join(x for _, x in ta) == whole == b"".join(x for _, x in tb)
        return (ta, tb) if same else ([], [])

    return tokens


def brute(tokens, rows):
    """The contract read literally: rows of (doc_id, text)."""
    found = []
    for doc_id, text in rows:
        ta, tb = tokens(text)
        ends = []
        for side in (ta, tb):
            at, own = 0, []
            for i, x in side:
                at += len(x)
                own.append((i, at))
            ends.append(own)
        cuts = sorted({e for _, e in ends[0]} & {e for _, e in ends[1]})
        groups = []
        for c in cuts:
            own = []
            for side in ends:
                upto = next((k for k, (_, e) in enumerate(side) if e > c), len(side))
                own.append([i for i, _ in side[:upto]])
                del side[:upto]
            groups.append(tuple(own))
        found.append((doc_id, len(ta), len(tb), groups))
    counts = Counter()
    for *_, groups in found:
        counts.update({(x, y) for a, b in groups for x in a for y in b})
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, n_a, n_b, groups in found:
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if n_a else ""))
    return sorted(out, key=repr)


ODD = [
    (1, "The quick brown fox, naïve café — 東京 is big."), (2, None), (3, ""), (4, " "), (5, "a  b   c \n\n d\t"),
    (6, "<|endoftext|> and </s> <s> <unk> <0x41>"), (7, "already ▁ a blank piece"), (8, "x\u0000y 　 z"),
    (None, "no id here"), (1, "The quick brown fox, naïve café — 東京 is big."), (9, "ab" * 700 + "aaab" * 300),
    (10, "\U0001F600\U0001F601 emoji ́"), (11, "one"), (12, "é" * 500), (13, "0123456789" * 60),
]


def test_alignment_equals_the_definition(spark, plain):
    got = rows_of(align(docs(spark, ODD)), *COLUMNS)
    assert got == brute(plain, ODD)
    by = {r[0]: r for r in got}
    assert by[2][1:] == by[3][1:] == by[7][1:] == (0,) * 6 + ("",)


def test_counts_by_join_and_small_buckets_agree(spark, plain):
    d = docs(spark, ODD)
    assert rows_of(align(d, broadcast_pairs=0, bucket_keys=7), *COLUMNS) == brute(plain, ODD)
    assert rows_of(align(d, bucket_keys=7), *COLUMNS) == brute(plain, ODD)


def test_query_on_a_table(spark, plain):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert rows_of(op12_align(spark, SF001), *COLUMNS) == brute(plain, rows)


def test_large_groups_are_counted_without_listing_links(monkeypatch, spark, plain):
    import skein.llm.op12_align as m

    monkeypatch.setattr(m, "SMALL_GROUP", 1)
    monkeypatch.setattr(m, "BLOCK_LINKS", 3)
    pair = Pair(tokenizer_files(), piece_file())
    texts = [t for _, t in ODD if t]
    ids = [x for x in pair.encode(texts) if len(x[0])]
    slow = Counter()
    for d, key, n in m.Aligned(ids, pair.len_a, pair.len_b).links(len(pair.b)):
        slow.update(dict(zip(zip(d.tolist(), key.tolist()), n.tolist()))) if len(set(key.tolist())) == len(key) else [
            slow.update({(x, y): z}) for x, y, z in zip(d.tolist(), key.tolist(), n.tolist())]
    monkeypatch.setattr(m, "SMALL_GROUP", 1 << 60)
    fast = Counter()
    for d, key, n in m.Aligned(ids, pair.len_a, pair.len_b).links(len(pair.b)):
        for x, y, z in zip(d.tolist(), key.tolist(), n.tolist()):
            fast[x, y] += z
    assert slow == fast


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_hash_is_minimal_perfect_and_verified(n):
    r = np.random.default_rng(n)
    keys = np.unique(r.integers(0, 1 << 31, n))
    sizes, words, by_position = build_hash(keys)
    t = PairTable([sizes], [words], [by_position])
    assert sorted(t.positions(keys).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(r.integers(0, 1 << 31, 2000), keys)
    assert (t.positions(others) == -1).all()
    assert len(words) * 64 <= 64 * 40 + 4 * len(keys)


def test_tables_of_several_buckets():
    keys = np.arange(0, 90_000, 7)
    b = bucket_of(keys, 5)
    built = [build_hash(keys[b == k]) for k in range(5)]
    t = PairTable(*zip(*built))
    assert sorted(t.positions(keys).tolist()) == list(range(len(keys)))


def test_empty_table(spark):
    got = align(docs(spark, [(1, "x")]).limit(0))
    assert got.columns == list(COLUMNS) and got.count() == 0
    assert rows_of(align(docs(spark, [(1, None)])), *COLUMNS) == [(1, 0, 0, 0, 0, 0, 0, "")]
