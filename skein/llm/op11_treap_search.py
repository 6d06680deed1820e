"""Ranked lexical search by K2-treaps over blocks of the term-document grid.

Index.  Documents are cut into blocks, in each task as they come.  A block's grid
has a row per term and a column per document; a cell with postings holds the
impact (1000000000 tf) div (1000 tf + 20 m).  Rows are ordered by falling document
frequency (by powers of two, then by first column), columns by which of the
block's most frequent terms they hold, so that postings lie close together.  The
grid is a quadtree: a node is split into the quarters of its rows and columns (in
halves as long as only one of them can be split), empty quarters are not stored, and
every node holds the greatest impact below it - as its fall from its parent's, which
is mostly zero and compresses well.  A node is a byte saying which quarters exist
and a fall; children are found by counting quarters (rank).  One index row per block.

Search.  In a block an item starts with its terms' row paths at the root and the
whole document range.  A range's bound is the sum over the terms of weight times
the greatest impact of the node that the term's path has reached there.  The
ranges with the highest bounds are split first (``width`` ranges of every item at
a time): all row paths of the item descend together into the halves of the range,
terms without postings there drop out.  A single document's bound is its score.
A range whose bound is below the item's ``k``-th score so far is never opened;
those scores carry over from block to block in a task, and Spark merges the tasks'
lists.  A range with a bound equal to it is opened, so ties go by doc_id exactly.

Weights need the documents' df of the items' terms, read from the blocks'
vocabularies (terms and frequencies only), summed by Spark.  Items come in chunks
of at most ``chunk_terms`` (item, term) pairs, each broadcast and searched in turn.

Defined results
* null text, or no term: the document has no term and is never found;
* an item without terms, or whose terms no document holds: no rows;
* items of the same item_id are one item with the terms of all of them; a null
  item_id is an item of its own;
* repeated documents are ranked each; equal scores by doc_id, a null one last;
* an empty table of either kind gives no rows; other columns are ignored;
* a text of any length is indexed whole (a block holds at least one document).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import lower_ascii, slices, table
from skein.session import fresh_dir

#: A term: a run of characters other than ASCII ones that are neither letters nor digits.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 50
#: Documents (a power of two) and term occurrences that close a block.
BLOCK_DOCS, BLOCK_TERMS = 1024, 400_000
_SEPARATE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32
                  for b in range(256))
INDEX_SCHEMA = ("ids binary, no_id binary, terms binary, dfs binary, row_bits int, col_bits int, sizes array<bigint>, "
                "quarters binary, falls binary")


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text as UTF-8, A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(_SEPARATE).split()


def _bits(n: int) -> int:
    return max(0, int(n - 1).bit_length())


def _first(sorted_keys: np.ndarray) -> np.ndarray:
    """Positions at which a sorted array has a new value."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(new)


@dataclass
class Treap:
    """A block's quadtree: per level (root first) node counts; over all nodes in level order the
    bytes of existing quarters (1 << 2 row + column; none for cells) and the greatest impacts."""

    row_bits: int
    col_bits: int
    sizes: np.ndarray
    quarters: np.ndarray
    most: np.ndarray

    @property
    def depth(self) -> int:
        return max(self.row_bits, self.col_bits)

    @classmethod
    def build(cls, rows: np.ndarray, cols: np.ndarray, impact: np.ndarray, n_rows: int, n_cols: int) -> Treap:
        """From postings (row, column, impact), each cell once, at least one."""
        rb, cb = _bits(n_rows), _bits(n_cols)
        depth = max(rb, cb)
        path = np.zeros(len(rows), np.int64)
        for bit in range(depth):
            path |= ((rows >> bit) & 1) << (2 * bit + 1) | ((cols >> bit) & 1) << (2 * bit)
        order = np.argsort(path, kind="stable")
        key, most = path[order], impact[order]
        quarters, mosts = [], [most]
        for _ in range(depth):
            up = key >> 2
            first = _first(up)
            quarters.append(np.bitwise_or.reduceat(np.left_shift(1, key & 3), first).astype(np.uint8))
            key, most = up[first], np.maximum.reduceat(most, first)
            mosts.append(most)
        quarters.reverse()
        mosts.reverse()
        return cls(rb, cb, np.array([len(m) for m in mosts], np.int64),
                   np.concatenate([*quarters, np.zeros(0, np.uint8)]), np.concatenate(mosts))

    def falls(self) -> np.ndarray:
        """Every node's fall from its parent's greatest impact; the root's is its own."""
        out = self.most.copy()
        out[1:] = self.most[self._parents()] - self.most[1:]
        return out

    def _parents(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.quarters)), _COUNT[self.quarters])

    @classmethod
    def from_falls(cls, row_bits: int, col_bits: int, sizes: np.ndarray, quarters: np.ndarray,
                   falls: np.ndarray) -> Treap:
        out = cls(row_bits, col_bits, sizes, quarters, falls.astype(np.int64))
        parents, at = out._parents(), 1
        for n in sizes[1:]:
            out.most[at:at + n] = out.most[parents[at - 1:at - 1 + n]] - out.most[at:at + n]
            at += n
        return out

    def children(self) -> np.ndarray:
        """First child of every inner node."""
        return 1 + np.concatenate([[0], np.cumsum(_COUNT[self.quarters])[:-1]]).astype(np.int64)


_COUNT = np.array([bin(k).count("1") for k in range(16)], dtype=np.int64)


# --- building -----------------------------------------------------------------


def _block(ids: list, words: list[bytes], lengths: list[int], n_docs: int, n_terms: int) -> list:
    """One index row (without its last names) from the documents' ids, terms and term counts."""
    codes, names = pd.factorize(np.array(words, dtype=object))
    doc = np.repeat(np.arange(len(ids)), lengths)
    cells, tf = np.unique(codes.astype(np.int64) * len(ids) + doc, return_counts=True)
    code, col = cells // len(ids), cells % len(ids)
    df = np.bincount(code, minlength=len(names))
    # Columns by their frequent terms, so that a range lacks as many terms as possible.
    top = np.argsort(-df, kind="stable")[:48]
    place = np.full(len(names), -1)
    place[top] = np.arange(len(top))
    held = place[code]
    signature = np.zeros(len(ids), np.int64)
    np.bitwise_or.at(signature, col[held >= 0], np.left_shift(np.int64(1), 48 - held[held >= 0]))
    by = np.lexsort((np.array(lengths), signature))
    new_col = np.empty(len(ids), np.int64)
    new_col[by] = np.arange(len(ids))
    col = new_col[col]
    first = np.full(len(names), len(ids))
    np.minimum.at(first, code, col)
    order = np.lexsort((first, -np.floor(np.log2(df)).astype(np.int64)))
    row_of = np.empty(len(names), np.int64)
    row_of[order] = np.arange(len(names))
    n = np.array(lengths, dtype=np.int64)[by]
    m = 100 - 50 + (50 * n * n_docs) // n_terms
    impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[col])
    treap = Treap.build(row_of[code], col, impact, len(names), len(ids))
    own = [ids[k] for k in by]
    return [np.array([0 if i is None else i for i in own], np.int64).tobytes(),
            np.array([i is None for i in own], np.uint8).tobytes(),
            b" ".join(names[order].tolist()), df[order].astype(np.int32).tobytes(), treap.row_bits, treap.col_bits,
            treap.sizes.tolist(), treap.quarters.tobytes(), treap.falls().astype(np.int32).tobytes()]


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(N, L): documents with a term, and all their terms with repeats."""
    n = F.coalesce(F.regexp_count("text", F.lit(TERM)), F.lit(0)).cast("bigint")
    r = docs.select(n.alias("n")).agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return int(r[0]), int(r[1])


def build_index(docs: DataFrame, n_docs: int, n_terms: int, block_docs: int = BLOCK_DOCS,
                block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The treaps of all documents (doc_id, text), a row per block, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, lengths = [], [], []

        def close() -> pa.RecordBatch:
            row = _block(ids, words, lengths, n_docs, n_terms)
            for x in (ids, words, lengths):
                x.clear()
            types = [pa.binary()] * 4 + [pa.int32()] * 2 + [pa.list_(pa.int64())] + [pa.binary()] * 2
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                              [c.split()[0] for c in INDEX_SCHEMA.split(", ")])

        for part in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own = terms(text)
                if own:
                    ids.append(doc_id)
                    words += own
                    lengths.append(len(own))
                    if len(ids) >= block_docs or len(words) >= block_terms:
                        yield close()
        if ids:
            yield close()

    spark = docs.sparkSession
    path = fresh_dir(spark, "treap-index")
    out = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, INDEX_SCHEMA)
    out.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


# --- searching ----------------------------------------------------------------


class Best:
    """The ``k`` best (score, document) of every item so far: highest score, then smallest id, null last."""

    def __init__(self, items: int, k: int):
        self.items, self.k = items, k
        self.item = self.score = self.no_id = self.id = np.zeros(0, np.int64)
        self.least = np.ones(items, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        no_id, ids = np.concatenate([self.no_id, no_id]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, no_id, -score, item))
        item = item[order]
        first = _first(item)
        rank = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        keep = order[rank < self.k]
        full = rank == self.k - 1
        self.least[item[full]] = score[order[full]]
        self.item, self.score, self.no_id, self.id = item[rank < self.k], score[keep], no_id[keep], ids[keep]


def search_block(treap: Treap, no_id: np.ndarray, ids: np.ndarray, item: np.ndarray, row: np.ndarray,
                 weight: np.ndarray, best: Best, width: int = 64) -> int:
    """Search one block for (item, row, weight), sorted by item; adds to ``best``.

    Returns the number of nodes opened.
    """
    depth, rb, cb = treap.depth, treap.row_bits, treap.col_bits
    child, quarters, most = treap.children(), treap.quarters, treap.most
    opened = 0
    # Ranges: item, depth, column prefix, bound; and their terms: range number, node, row, weight.
    first = _first(item)
    r_item, r_depth, r_col = item[first], np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
    t_range = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(item))))
    t_node, t_row, t_weight = np.zeros(len(item), np.int64), row, weight
    r_bound = np.bincount(t_range, weight * most[0], len(first)).astype(np.int64)
    while len(r_item):
        # Done ranges become results; then those that can't reach the k best go.
        done = r_depth == depth
        if done.any():
            cols = r_col[done]
            best.add(r_item[done], r_bound[done], no_id[cols], ids[cols])
        open_ = ~done & (r_bound >= best.least[r_item])
        order = np.lexsort((-r_bound, r_item, ~open_))[:int(open_.sum())]
        first = _first(r_item[order]) if len(order) else np.zeros(0, np.int64)
        rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        pick = np.zeros(len(r_item), bool)
        pick[order[rank < width]] = True
        stay = open_ & ~pick
        # Split the picked ranges: every term's path goes into both column halves.
        mine = pick[t_range]
        of, node, rows, w = t_range[mine], t_node[mine], t_row[mine], t_weight[mine]
        opened += len(node)
        left = depth - 1 - r_depth[of]
        row_bit = np.where(left < rb, (rows >> left) & 1, 0)
        split = left < cb
        parts = []
        for half in (0, 1):
            quarter = 2 * row_bit + half
            there = (quarters[node] >> quarter) & 1 == 1
            if half:
                there &= split
            n = node[there]
            below = quarters[n] & (np.left_shift(1, quarter[there]) - 1)
            parts.append((of[there] * 2 + half, child[n] + _COUNT[below], rows[there], w[there]))
        key, node, rows, w = (np.concatenate(x) for x in zip(*parts))
        names, number = np.unique(key, return_inverse=True)
        from_ = names >> 1
        new_bound = np.zeros(len(names), np.int64)
        np.add.at(new_bound, number, w * most[node])
        new_depth = r_depth[from_] + 1
        new_col = np.where(depth - new_depth < cb, r_col[from_] * 2 + (names & 1), 0)
        # The ranges that wait keep their terms.
        renumber = np.cumsum(stay) - 1
        keep = stay[t_range]
        t_range = np.concatenate([renumber[t_range[keep]], number + int(stay.sum())])
        t_node, t_row = np.concatenate([t_node[keep], node]), np.concatenate([t_row[keep], rows])
        t_weight = np.concatenate([t_weight[keep], w])
        r_item, r_depth = np.concatenate([r_item[stay], r_item[from_]]), np.concatenate([r_depth[stay], new_depth])
        r_col, r_bound = np.concatenate([r_col[stay], new_col]), np.concatenate([r_bound[stay], new_bound])
    return opened


def term_frequencies(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """term, df of the ``wanted`` terms (column term, distinct) that documents hold."""
    shared = index.sparkSession.sparkContext.broadcast({r["term"].encode() for r in wanted.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for batch in batches:
            found, counts = [], []
            for names, dfs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                df = np.frombuffer(dfs, np.int32)
                for k, t in enumerate(names.split(b" ")):
                    if t in asked:
                        found.append(t.decode())
                        counts.append(int(df[k]))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(counts, pa.int64())], ["term", "n"])

    return index.select("terms", "dfs").mapInArrow(run, "term string, n bigint").groupBy("term").agg(
        F.sum("n").alias("df"))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term: every item's distinct terms."""
    found = F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(f"({TERM})"), F.lit(1)))
    return items.select("item_id", found.alias("term")).distinct()


def search(index: DataFrame, items: DataFrame, n_docs: int, k: int = K, width: int = 64,
           chunk_terms: int = 200_000) -> DataFrame:
    """item_id, rank, doc_id, score of every item's ``k`` best documents in the index."""
    spark = index.sparkSession
    pairs = item_terms(items)
    chunks = max(1, -(-pairs.count() // chunk_terms))
    out = None
    for chunk in range(chunks):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(chunks)) == chunk) if chunks > 1 else pairs
        df = term_frequencies(index, own.select("term").distinct())
        w = F.floor(1000 * F.log((F.lit(2.0 * n_docs) + 2) / (2 * F.col("df") + 1))).cast("bigint")
        weighted = own.join(df, "term").select("item_id", "term", w.alias("w")).collect()
        if not weighted:
            continue
        names = sorted({r["item_id"] for r in weighted}, key=lambda v: (v is None, v if v is not None else 0))
        number = {v: n for n, v in enumerate(names)}
        of_term: dict[bytes, list[tuple[int, int]]] = {}
        for r in weighted:
            of_term.setdefault(r["term"].encode(), []).append((number[r["item_id"]], r["w"]))
        shared = spark.sparkContext.broadcast((of_term, len(names)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked, n_items = shared.value
            best = Best(n_items, k)
            for batch in batches:
                for at in range(batch.num_rows):
                    ids, no_id, words, rb, cb, sizes, quarters, falls = (c[at].as_py() for c in batch.columns)
                    hits = [(i, r, w) for r, t in enumerate(words.split(b" ")) if t in asked for i, w in asked[t]]
                    if not hits:
                        continue
                    item, row, weight = np.array(hits, dtype=np.int64).T
                    by = np.argsort(item, kind="stable")
                    treap = Treap.from_falls(rb, cb, np.array(sizes), np.frombuffer(quarters, np.uint8),
                                             np.frombuffer(falls, np.int32))
                    search_block(treap, np.frombuffer(no_id, np.uint8).astype(np.int64),
                                 np.frombuffer(ids, np.int64), item[by], row[by], weight[by], best, width)
            if len(best.item):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(best.item.astype(np.int32)), pa.array(best.id, mask=best.no_id == 1), pa.array(best.score)],
                    ["item", "doc_id", "score"])

        found = index.select("ids", "no_id", "terms", "row_bits", "col_bits", "sizes", "quarters", "falls").mapInArrow(
            run, "item int, doc_id bigint, score bigint")
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        item_type = items.schema["item_id"].dataType.simpleString()
        named = spark.createDataFrame(list(enumerate(names)), f"item int, item_id {item_type}")
        part = ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return items.select("item_id").limit(0).select(
            "item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score"))
    return out


def op11_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_docs, n_terms = corpus_size(docs)
    if not n_terms:
        n_docs = n_terms = 1
    return search(build_index(docs, n_docs, n_terms), table(spark, sf_dir, "benchmark", spread=False), n_docs)


OP11_SQL = r"""
WITH toks AS MATERIALIZED (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
tf AS MATERIALIZED (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM toks GROUP BY ALL),
len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
tot AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM len),
df AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM tf GROUP BY term),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
w AS (
  SELECT item_id, term,
         CAST(floor(1000 * ln((CAST(2 AS DOUBLE) * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM items JOIN df USING (term), tot
),
scored AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM w JOIN tf USING (term) JOIN len USING (doc_id), tot
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 50
"""
