"""Cross-tokenizer alignment with pair counts in vectors indexed by a minimal perfect hash.

A is a byte-level BPE over a blank and the text, B a sentencepiece BPE that puts the
blank itself.  Both cover the same bytes; where tokens of both end, a group ends.
All A-B occurrences of a group are linked.  Groups are found by marking token ends
on the bytes, so aligning is linear in the text.

1. Every task encodes its texts (whole), checks that both sides spell them, writes the
   ids, aligns, and counts in how many of its documents each id pair is linked: one
   row of keys (A id times B's size, plus B id) and counts per task, or several.
2. The distinct keys are dealt by a hash into buckets of about ``bucket_keys``.  Each
   bucket gets its own minimal perfect hash (a cascade of bit arrays: a key that
   has a bit alone keeps it, the others go on to the next array; a key's
   position is the number of set bits before its own), and its keys in the order of their
   positions, so that a key never counted is told from one that was.
3. A task's counts become dense vectors, one per bucket, by position; vectors are
   added in two levels, ``fan`` per bucket and then one.
4. The ids are read again and aligned again; every document's pairs are hashed, their
   keys verified and their counts read.  Up to ``broadcast_pairs`` pairs the hash
   tables are broadcast (16 bytes a pair); beyond, the same counts meet the
   documents' pairs by a join on the pair.

A group of many tokens (bytes where ends never meet) is reduced to its distinct ids
with their numbers before pairs are formed, in blocks, so no list of all its links exists.

Defined results
* null or empty text, or one that either side does not spell back: no tokens, all
  figures 0, ``groups_sha256`` the empty string;
* special tokens' strings in a text are plain text;
* repeated documents count as often as they occur; null ids are kept;
* an empty table gives no rows; other columns are ignored;
* a text of any length is encoded and aligned whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import cut, table
from skein.llm.op4_pack import _ADJACENT, ByteBpe, tokenizer_files

#: Bytes of text that are aligned at once, unless one text has more.
BLOCK_BYTES = 1 << 20
#: Products of a group up to which its links are listed one by one.
SMALL_GROUP = 64
#: Links formed at once of a larger group; counted pairs that a task holds before it hands them over.
BLOCK_LINKS, FLUSH_PAIRS = 1 << 20, 2_000_000
_BLANK = "▁"


def piece_file() -> str:
    """Default sentencepiece model."""
    import public_tokenizers as files

    return files.path("piece_bpe_32k.model")


class Pair:
    """Both tokenizers, and the bytes of all their tokens."""

    def __init__(self, bpe_files: tuple[str, str, str], model_file: str):
        import sentencepiece

        self.bpe = ByteBpe(*bpe_files)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model_file)
        letters = _byte_letters()
        whole = self.bpe.whole
        self.a = [bytes(letters[c] for c in whole.id_to_token(i)) if all(c in letters for c in whole.id_to_token(i))
                  else whole.id_to_token(i).encode() for i in range(whole.get_vocab_size())]
        p = self.pieces
        self.b = [bytes([int(p.id_to_piece(i)[3:-1], 16)]) if p.is_byte(i)
                  else b"" if p.is_control(i) or p.is_unknown(i)
                  else p.id_to_piece(i).replace(_BLANK, " ").encode() for i in range(p.get_piece_size())]
        self.len_a = np.array([len(x) for x in self.a], np.int64)
        self.len_b = np.array([len(x) for x in self.b], np.int64)

    def _a_ids(self, text: str) -> bytes:
        """Ids of a blank and the text; one without adjacent white space falls apart at its blanks."""
        if _ADJACENT.search(text):
            return self.bpe._encode(" " + text)
        return self.bpe.ids_of_parts([" " + part for part in text.split(" ")])

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(A ids, B ids) of every text; empty where a side does not spell it."""
        out = []
        for text, b in zip(texts, self.pieces.encode([t or "" for t in texts], num_threads=1)):
            ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if text:
                a, whole = np.frombuffer(self._a_ids(text), "<u4"), (" " + text).encode("utf-8", "replace")
                if b"".join(map(self.a.__getitem__, a.tolist())) == whole and (
                        b"".join(map(self.b.__getitem__, b)) == whole) and self.len_b[b].all():
                    ids = a.astype(np.int64), np.array(b, np.int64)
            out.append(ids)
        return out


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write bytes as letters: printable Latin-1 bytes as themselves,
    the others, in order, as the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


_LOADED: dict[tuple, Pair] = {}


def loaded(bpe_files: tuple[str, str, str], model_file: str) -> Pair:
    """The tokenizers, once per worker."""
    if (bpe_files, model_file) not in _LOADED:
        _LOADED[bpe_files, model_file] = Pair(bpe_files, model_file)
    return _LOADED[bpe_files, model_file]


class Aligned:
    """The groups of a few documents that have tokens, from their ids.

    ``group_a``, ``group_b``: group of every token; ``doc``: document of every group.
    """

    def __init__(self, ids: list[tuple[np.ndarray, np.ndarray]], len_a: np.ndarray, len_b: np.ndarray):
        self.docs = len(ids)
        self.a = np.concatenate([a for a, _ in ids])
        self.b = np.concatenate([b for _, b in ids])
        ends_a, ends_b = np.cumsum(len_a[self.a]), np.cumsum(len_b[self.b])
        mark = np.zeros(int(ends_a[-1]) + 1, np.uint8)
        mark[ends_a] = 1
        mark[ends_b] += 2
        both = mark == 3
        upto = np.cumsum(both, dtype=np.int32)
        self.group_a = upto[ends_a] - both[ends_a]
        self.group_b = upto[ends_b] - both[ends_b]
        self.groups = int(upto[-1])
        self.n_a, self.n_b = np.bincount(self.group_a), np.bincount(self.group_b)
        self.start_a = np.cumsum(self.n_a) - self.n_a
        self.start_b = np.cumsum(self.n_b) - self.n_b
        #: Position behind each document's last A and B token, and its last group.
        self.end_a = np.cumsum([len(a) for a, _ in ids])
        self.end_b = np.cumsum([len(b) for _, b in ids])
        self.end_group = self.group_a[self.end_a - 1] + 1
        self.doc = np.repeat(np.arange(self.docs), np.diff(self.end_group, prepend=0))

    def links(self, size_b: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, key, links) blocks; a key may come again for the same document."""
        product = self.n_a.astype(np.int64) * self.n_b
        small = np.flatnonzero(product <= SMALL_GROUP)
        n = product[small]
        g = np.repeat(small, n)
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        i, j = np.divmod(at, self.n_b[g])
        yield self.doc[g], self.a[self.start_a[g] + i] * size_b + self.b[self.start_b[g] + j], np.ones(len(g), np.int64)
        for g in np.flatnonzero(product > SMALL_GROUP).tolist():
            a, times_a = np.unique(self.a[self.start_a[g]:self.start_a[g] + self.n_a[g]], return_counts=True)
            b, times_b = np.unique(self.b[self.start_b[g]:self.start_b[g] + self.n_b[g]], return_counts=True)
            rows = max(1, BLOCK_LINKS // len(b))
            for k in range(0, len(a), rows):
                key = (a[k:k + rows, None] * size_b + b).ravel()
                yield np.full(len(key), self.doc[g]), key, (times_a[k:k + rows, None] * times_b).ravel()

    def digests(self, names: list[bytes], size: int) -> list[str]:
        """The sha256 of every document's groups; ``names`` holds each id (below ``size``) before
        a comma, a bar, a semicolon and nothing."""
        before_a = np.append(self.start_a, len(self.a))
        code_a, code_b = self.a.copy(), self.b.copy()
        code_a[before_a[1:] - 1] += size
        code_b[self.start_b + self.n_b - 1] += 2 * size
        code_b[self.end_b - 1] += size
        line = np.empty(len(self.a) + len(self.b), np.int64)
        line[np.arange(len(self.a)) + self.start_b[self.group_a]] = code_a
        line[np.arange(len(self.b)) + before_a[self.group_b + 1]] = code_b
        out, at = [], 0
        for end in (self.end_a + self.end_b).tolist():
            out.append(hashlib.sha256(b"".join(map(names.__getitem__, line[at:end].tolist()))).hexdigest())
            at = end
        return out


def blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that ``column`` (text or bytes) has about ``BLOCK_BYTES`` in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        of = np.cumsum(lengths, dtype=np.int64) // BLOCK_BYTES
        at = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), batch.num_rows]
        for a, b in zip(at, at[1:]):
            for k in range(a, b, 1024):
                yield batch.slice(k, min(1024, b - k))


# --- the perfect hash ---------------------------------------------------------


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (keys.astype(np.uint64) + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of every key."""
    return (_hash(keys, 999) % np.uint64(buckets)).astype(np.int64)


def build_hash(keys: np.ndarray, gamma: float = 1.5) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, all levels' bits in 64-bit words, keys by position) for distinct keys."""
    sizes, found, words = [], [], []
    rest = keys
    while len(rest):
        size = -(-max(64, int(gamma * len(rest))) // 64) * 64
        at = (_hash(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, bool)
        bits[at[alone]] = True
        found.append(rest[alone][np.argsort(at[alone])])
        words.append(np.packbits(bits, bitorder="little").view("<u8"))
        sizes.append(size)
        rest = rest[~alone]
    if not sizes:
        return [], np.zeros(0, "<u8"), keys
    return sizes, np.concatenate(words), np.concatenate(found)


class PairTable:
    """Positions of keys under the hashes of all buckets, verified; with their counts if given."""

    def __init__(self, sizes: list[list[int]], words: list[np.ndarray], keys: list[np.ndarray],
                 counts: list[np.ndarray] | None = None):
        self.buckets = len(sizes)
        levels = max([len(s) for s in sizes], default=0)
        self.size = np.zeros((self.buckets, levels), np.int64)
        for k, s in enumerate(sizes):
            self.size[k, :len(s)] = s
        total = self.size.sum(1)
        self.offset = np.cumsum(self.size, axis=1) - self.size + (np.cumsum(total) - total)[:, None]
        self.words = np.concatenate([*words, np.zeros(0, "<u8")])
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.rank = np.cumsum(ones) - ones
        self.keys = np.concatenate([*keys, np.zeros(0, np.int64)])
        self.counts = np.concatenate(counts) if counts else None

    def positions(self, keys: np.ndarray) -> np.ndarray:
        """Position of every key among all keys, -1 for keys that aren't there."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys)) if self.buckets else np.zeros(0, np.int64)
        bucket = bucket_of(keys, self.buckets) if self.buckets else out
        for level in range(self.size.shape[1]):
            b = bucket[open_]
            size = self.size[b, level]
            open_, b, size = open_[size > 0], b[size > 0], size[size > 0]
            if not len(open_):
                break
            bit = self.offset[b, level] + (_hash(keys[open_], level) % size.astype(np.uint64)).astype(np.int64)
            word, place = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> place) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << place) - np.uint64(1)))
            out[open_[hit]] = self.rank[bit[hit] >> 6] + below[hit]
            open_ = open_[~hit]
        there = out >= 0
        out[there] = np.where(self.keys[out[there]] == keys[there], out[there], -1)
        return out


# --- the Spark side -----------------------------------------------------------

FIRST = "doc_id bigint, a binary, b binary, keys binary, counts binary"
HASHES = "bucket int, sizes array<bigint>, words binary, keys binary"


def _ids(a: bytes, b: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(b, "<u2").astype(np.int64)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n[order], first) if len(key) else n


def encoded(docs: DataFrame, bpe_files: tuple[str, str, str], model_file: str) -> DataFrame:
    """A row per document with its ids (16 bits each), and rows of pairs with the number of the
    task's documents that link them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(bpe_files, model_file)
        if max(len(pair.a), len(pair.b)) > 1 << 16:
            raise ValueError("ids are kept in 16 bits: a vocabulary has more than 65,536 entries")
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        names = [f.split()[0] for f in FIRST.split(", ")]

        def hand_over() -> pa.RecordBatch:
            k, n = _merged(keys, counts)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.binary())] * 2,
                 pa.array([k.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], names)

        for part in blocks(batches, 1):
            ids = pair.encode(part.column(1).to_pylist())
            full = [x for x in ids if len(x[0])]
            if full:
                linked = [(d << 32) | key for d, key, _ in Aligned(full, pair.len_a, pair.len_b).links(len(pair.b))]
                once = np.unique(np.concatenate(linked)) & 0xFFFFFFFF
                k, n = np.unique(once, return_counts=True)
                keys.append(k)
                counts.append(n.astype(np.int64))
                if sum(map(len, keys)) > FLUSH_PAIRS:
                    k, n = _merged(keys, counts)
                    keys[:], counts[:] = [k], [n]
                    if len(k) > FLUSH_PAIRS // 2:
                        yield hand_over()
                        keys.clear()
                        counts.clear()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([a.astype("<u2").tobytes() for a, _ in ids], pa.binary()),
                 pa.array([b.astype("<u2").tobytes() for _, b in ids], pa.binary()),
                 pa.nulls(len(ids), pa.binary()), pa.nulls(len(ids), pa.binary())], names)
        if keys:
            yield hand_over()

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, FIRST)


def perfect_hashes(counted: DataFrame, bucket_keys: int) -> tuple[DataFrame, int, int]:
    """(hash of every bucket, buckets, distinct pairs) of the counted pairs."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(blob, np.int64))], ["key"])

    distinct = cut(counted.select("keys").mapInArrow(each, "key bigint").distinct(), "align-keys")
    total = distinct.count()
    buckets = max(1, math.ceil(total / bucket_keys))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = bucket_of(batch.column(0).to_numpy(), buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), batch.column(0)], ["bucket", "key"])

    def build(t: pa.Table) -> pa.Table:
        sizes, words, keys = build_hash(t.column("key").to_numpy())
        return pa.table({"bucket": t.column("bucket").slice(0, 1).cast(pa.int32()),
                         "sizes": pa.array([sizes], pa.list_(pa.int64())),
                         "words": pa.array([words.tobytes()], pa.binary()),
                         "keys": pa.array([keys.tobytes()], pa.binary())})

    placed = distinct.mapInArrow(place, "bucket int, key bigint")
    return cut(placed.groupBy("bucket").applyInArrow(build, HASHES), "align-hashes"), buckets, total


def pair_counts(counted: DataFrame, hashes: DataFrame, buckets: int, fan: int = 16) -> DataFrame:
    """bucket, counts: the documents of every pair, in a vector by position."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                k, n = np.frombuffer(keys, np.int64), np.frombuffer(counts, np.int64)
                b = bucket_of(k, buckets)
                order = np.argsort(b, kind="stable")
                names, first = np.unique(b[order], return_index=True)
                parts = np.split(order, first[1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.astype(np.int32)), pa.array([k[p].tobytes() for p in parts], pa.binary()),
                     pa.array([n[p].tobytes() for p in parts], pa.binary())], ["bucket", "keys", "counts"])

    def dense(parts: pa.Table, own: pa.Table) -> pa.Table:
        if not len(own):
            return pa.table({"bucket": pa.nulls(0, pa.int32()), "counts": pa.nulls(0, pa.binary())})
        bucket = own.column("bucket")[0].as_py()
        one = PairTable([own.column("sizes")[0].as_py()], [np.frombuffer(own.column("words")[0].as_py(), "<u8")],
                        [np.frombuffer(own.column("keys")[0].as_py(), np.int64)])
        vector = np.zeros(len(one.keys), np.int64)
        for keys, counts in zip(parts.column("keys").to_pylist(), parts.column("counts").to_pylist()):
            vector[one.positions(np.frombuffer(keys, np.int64))] += np.frombuffer(counts, np.int64)
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "counts": pa.array([vector.tobytes()], pa.binary())})

    def add(t: pa.Table) -> pa.Table:
        vectors = [np.frombuffer(v, np.int64) for v in t.column("counts").to_pylist()]
        return pa.table({"bucket": t.column("bucket").slice(0, 1), "counts": pa.array([sum(vectors).tobytes()], pa.binary())})

    parts = counted.select("keys", "counts").mapInArrow(split, "bucket int, keys binary, counts binary").withColumn(
        "salt", F.pmod(F.spark_partition_id(), F.lit(fan)))
    copies = hashes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(fan - 1))))
    sums = parts.groupBy("bucket", "salt").cogroup(copies.groupBy("bucket", "salt")).applyInArrow(
        dense, "bucket int, counts binary")
    return cut(sums.groupBy("bucket").applyInArrow(add, "bucket int, counts binary"), "align-counts")


def _flat_counts(tables: DataFrame) -> DataFrame:
    """key, count of every pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, np.int64)),
                                                  pa.array(np.frombuffer(counts, np.int64))], ["key", "count"])

    return tables.select("keys", "counts").mapInArrow(run, "key bigint, count bigint")


COLUMNS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def align(docs: DataFrame, bpe_files: tuple[str, str, str] | None = None, model_file: str | None = None,
          bucket_keys: int = 50_000, broadcast_pairs: int = 4_000_000) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    spark = docs.sparkSession
    bpe_files, model_file = bpe_files or tokenizer_files(), model_file or piece_file()
    first = cut(encoded(docs, bpe_files, model_file), "align-ids")
    counted = first.where("keys is not null")
    hashes, buckets, total = perfect_hashes(counted, bucket_keys)
    tables = hashes.join(pair_counts(counted, hashes, buckets), "bucket")
    size_b = len(loaded(bpe_files, model_file).b)
    flat = _flat_counts(tables)
    # At most one row per id of A.
    most = flat.groupBy(F.expr(f"key div {size_b}").alias("a")).agg(F.max("count").alias("most"))
    joined = total > broadcast_pairs
    shared = None
    if not joined:
        highest = np.zeros(len(loaded(bpe_files, model_file).a), np.int64)
        for r in most.collect():
            highest[r["a"]] = r["most"]
        rows = sorted(tables.collect(), key=lambda r: r["bucket"])
        by = {r["bucket"]: r for r in rows}
        empty = {"sizes": [], "words": b"", "keys": b"", "counts": b""}
        full = [by.get(k, empty) for k in range(buckets)]
        shared = spark.sparkContext.broadcast((PairTable(
            [list(r["sizes"]) for r in full], [np.frombuffer(r["words"], "<u8") for r in full],
            [np.frombuffer(r["keys"], np.int64) for r in full],
            [np.frombuffer(r["counts"], np.int64) for r in full]), highest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(bpe_files, model_file)
        size = max(len(pair.a), len(pair.b))
        names = [f"{k}{mark}".encode() for mark in (",", "|", ";", "") for k in range(size)]
        for part in blocks(batches, 2):
            ids = [_ids(a, b) for a, b in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
            where = np.array([k for k, x in enumerate(ids) if len(x[0])], dtype=np.int64)
            n = np.array([[len(a), len(b)] for a, b in ids], np.int64)
            figures = {c: np.zeros(len(ids), np.int64) for c in ("groups", "links", "best", "sum")}
            digests = [""] * len(ids)
            at_row, at_key, at_n = [], [], []
            if len(where):
                aligned = Aligned([ids[k] for k in where], pair.len_a, pair.len_b)
                figures["groups"][where] = np.diff(aligned.end_group, prepend=0)
                for k, d in zip(where.tolist(), aligned.digests(names, size)):
                    digests[k] = d
                for d, key, times in aligned.links(size_b):
                    np.add.at(figures["links"], where[d], times)
                    code, uniq = pd.factorize(key)
                    if joined:
                        both, number = np.unique(d * len(uniq) + code, return_inverse=True)
                        at_row.append(where[both // len(uniq)])
                        at_key.append(uniq[both % len(uniq)])
                        sums = np.zeros(len(both), np.int64)
                        np.add.at(sums, number, times)
                        at_n.append(sums)
                        continue
                    known, highest = shared.value
                    at = known.positions(uniq)
                    count = np.where(at >= 0, known.counts[at], 0)
                    best = (count == highest[uniq // size_b]).astype(np.int64)
                    np.add.at(figures["best"], where[d], times * best[code])
                    np.add.at(figures["sum"], where[d], times * count[code])
            out = [part.column(1), pa.array(n[:, 0]), pa.array(n[:, 1]), pa.array(figures["groups"]),
                   pa.array(figures["links"]), pa.array(digests, pa.string())]
            if joined:
                rows = np.concatenate([*at_row, np.zeros(0, np.int64)])
                key, times = np.concatenate([*at_key, np.zeros(0, np.int64)]), np.concatenate([*at_n, np.zeros(0, np.int64)])
                by = np.argsort(rows, kind="stable")
                ends = np.searchsorted(rows[by], np.arange(len(ids) + 1)).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(key[by]), pa.array(times[by])], ["key", "n"])
                out += [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pairs)]
            else:
                out += [pa.array(figures["best"]), pa.array(figures["sum"])]
            yield pa.RecordBatch.from_arrays(out, [*[c.split()[0] for c in COLUMNS.split(", ")],
                                                   *(("row", "pairs") if joined else ("n_best", "count_sum"))])

    ids = first.where("keys is null").select(F.monotonically_increasing_id().alias("row"), "doc_id", "a", "b")
    if not joined:
        out = ids.mapInArrow(run, f"{COLUMNS}, n_best bigint, count_sum bigint")
    else:
        own = cut(ids.mapInArrow(run, f"{COLUMNS}, row bigint, pairs array<struct<key:bigint,n:bigint>>"), "align-pairs")
        best = flat.withColumn("a", F.expr(f"key div {size_b}")).join(most, "a").select(
            "key", "count", F.when(F.col("count") == F.col("most"), 1).otherwise(0).alias("best"))
        asked = own.select("row", F.explode("pairs").alias("p")).select("row", "p.key", "p.n")
        sums = asked.join(best, "key").groupBy("row").agg(
            F.sum(F.col("n") * F.col("best")).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
        out = own.drop("pairs").join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Align both tokenizers on every document and count the linked pairs."""
    return align(table(spark, sf_dir, "documents"))
