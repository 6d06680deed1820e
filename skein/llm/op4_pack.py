"""Packing documents into sequences of a fixed length by bin completion.

Pieces of one length are interchangeable, so the packing is solved on the
histogram of lengths (at most ``size`` entries, whatever the number of
documents) on the driver; its answer is a list of sequence patterns with
multiplicities, again bounded by ``size``.  Spark tokenises, counts, ranks the
pieces of each length and looks up each piece's place in the broadcast pattern
table.

The solver is bin completion: take the largest length left, enumerate the
fillings of its sequence that no other filling dominates, and branch on them,
fullest first.  A branch whose waste exceeds what the best known solution allows
is pruned; the first solution is best-fit decreasing, every better one found
replaces it, and reaching the volume bound ends the search.  A chosen filling is
applied as often as its counts allow in one step.

The search is bounded (:class:`Limits`, a parameter of ``pack``): the fillings
enumerated for one sequence and the steps of that enumeration, the items up to which a
filling is tested for dominance (beyond, it is kept), and the nodes of the branching.  The
best solution found within them is used; it packs all pieces and is never worse than
best-fit decreasing.  ``search_report`` tells how far it is from the lower bound and
whether a limit ended it.

Ranks within a length come from counts per (bucket, length) with buckets of a few
thousand pieces, so a length that a third of all pieces share is no hot key.

Defined results
* null or empty text: one piece holding only the end id;
* repeated documents are packed as often as they occur;
* an empty table gives no rows; other input columns are ignored;
* a text of any length is tokenised whole; only documents of more than ``size``
  ids are cut, the first piece taking the remainder.
"""

from __future__ import annotations

import base64
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import cut, slices, table

SIZE = 1024
#: Pieces in one bucket of the ranking, on average.
BUCKET_ROWS = 4000
#: White space by Unicode; a text in which none stands beside another falls apart at its blanks.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ADJACENT = re.compile(f"[{SPACE}][{SPACE}]|^[{SPACE}]")
#: Characters beyond the Latin script's.
_BEYOND = re.compile("[\u0250-\U0010ffff]")
_CACHE_WORDS = 150_000


def tokenizer_files() -> tuple[str, str, str]:
    """Default vocabulary: its JSON file, the same vocabulary as ranks, and the split pattern."""
    import public_tokenizers as files

    return files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN


class ByteBpe:
    """Token ids of a byte-level BPE vocabulary as little-endian unsigned 32-bit bytes.

    ``ids`` gives what the tokenizer gives as its file loads: a special token's string in a
    text is that token.  ``ids_of_parts`` takes all parts as plain text.

    ``tokenizers`` holds the vocabulary; texts of Latin script are encoded whole through
    the same merges as ranks (several times faster).  Any other text, if it has no adjacent
    white space, splits at its blanks into parts that encode on their own (a blank belongs
    to the word behind it) and are remembered.
    """

    def __init__(self, json_file: str, rank_file: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.loaded = Tokenizer.from_file(json_file)
        self.special = [t.content for t in self.loaded.get_added_tokens_decoder().values()]
        self.whole = Tokenizer.from_file(json_file)
        self.whole.encode_special_tokens = True
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranked = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _encode(self, part: str) -> bytes:
        if _BEYOND.search(part):
            ids = self.whole.encode(part, add_special_tokens=False).ids
        else:
            ids = self.ranked.encode_ordinary(part)
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return np.array(self.loaded.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if not _BEYOND.search(text) or _ADJACENT.search(text):
            return self._encode(text)
        first, rest = _at_blanks(text)
        return self.ids_of_parts([first, *rest])

    def ids_of_parts(self, parts: list[str]) -> bytes:
        """Ids of parts that encode on their own."""
        if len(self.known) > _CACHE_WORDS:
            self.known.clear()
        known, out = self.known, []
        for part in parts:
            hit = known.get(part)
            out.append(hit if hit is not None else self._remember(part))
        return b"".join(out)

    def _remember(self, part: str) -> bytes:
        out = self.known[part] = self._encode(part)
        return out


def _at_blanks(text: str) -> tuple[str, list[str]]:
    parts = text.replace(" ", "\x00 ").split("\x00") if "\x00" not in text else [text]
    return parts[0], parts[1:]


_LOADED: dict[tuple, ByteBpe] = {}


def pieces(docs: DataFrame, size: int = SIZE, end_id: int = 2, with_ids: bool = False,
           files: tuple[str, str, str] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, if asked for) of every document."""
    files = files or tokenizer_files()
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (
        ", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if files not in _LOADED:
            _LOADED[files] = ByteBpe(*files)
        bpe, end = _LOADED[files], np.array([end_id], dtype="<u4").tobytes()
        for part in slices(batches, 512):
            rows = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                data = bpe.ids(text or "") + end
                n, at, k = len(data) // 4, 0, 0
                upto = n if n <= size else n % size or size
                while at < n:
                    own = data[4 * at:4 * upto]
                    row = (doc_id, k, at, upto - at, zlib.crc32(own))
                    rows.append(row + (np.frombuffer(own, "<u4").astype(np.int32),) if with_ids else row)
                    at, upto, k = upto, upto + size, k + 1
            cols = list(zip(*rows)) if rows else [()] * (5 + with_ids)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(cols)])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


# --- the solver: plain functions over {length: count} ---------------------------------


def _fits_into(items: list[int], bins: list[int]) -> bool:
    """Can ``items`` (descending) be put into bins of the given sizes?"""
    if not items:
        return True
    tried = set()
    for k, room in enumerate(bins):
        if room >= items[0] and room not in tried:
            tried.add(room)
            if _fits_into(items[1:], bins[:k] + [room - items[0]] + bins[k + 1:]):
                return True
    return False


@dataclass(frozen=True)
class Limits:
    """Bounds of the search: nodes of the branching; fillings enumerated for a sequence, and steps
    taken for that; items up to which a filling is tested for dominance."""

    nodes: int = 20_000
    fillings: int = 60
    steps: int = 400
    dominance_items: int = 8


def fillings(left: dict[int, int], lengths: list[int], room: int, limits: Limits = Limits()) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` from the lengths left (ascending list), fullest first.

    A filling whose items fit into another filling's items as bins is dominated;
    so where a single item fills the room exactly, it is the only one.
    """
    if left.get(room):
        return [(room,)]
    found: list[tuple[int, ...]] = []
    budget = limits.steps

    def grow(chosen: list[int], room: int, upto: int) -> None:
        nonlocal budget
        k = bisect_right(lengths, min(room, upto)) - 1
        leaf = True
        while k >= 0 and budget > 0 and len(found) < limits.fillings:
            item = lengths[k]
            k -= 1
            if left[item] <= chosen.count(item):
                continue
            leaf = False
            budget -= 1
            grow([*chosen, item], room - item, item)
        if leaf and chosen:
            found.append(tuple(chosen))

    grow([], room, room)
    found = sorted(set(found), key=lambda f: (-sum(f), [-x for x in f]))
    best: list[tuple[int, ...]] = []
    for f in found:
        if not any(sum(b) >= sum(f) and len(b) <= len(f) and len(f) <= limits.dominance_items and _fits_into(list(f), list(b)) for b in best):
            best.append(f)
    return best or [()]


def best_fit(counts: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit decreasing on counts: [(times, lengths of one sequence)]."""
    left, plan = dict(counts), []
    lengths = sorted(x for x, n in left.items() if n)
    while lengths:
        own, room = [lengths[-1]], size - lengths[-1]
        while True:
            k = bisect_right(lengths, room) - 1
            while k >= 0 and left[lengths[k]] <= own.count(lengths[k]):
                k -= 1
            if k < 0:
                break
            own.append(lengths[k])
            room -= lengths[k]
        plan.append((_apply(left, lengths, own), tuple(own)))
    return plan


def _apply(left: dict[int, int], lengths: list[int], own: list[int]) -> int:
    """Take the filling as often as the counts allow; returns how often."""
    need = {x: own.count(x) for x in own}
    times = min(left[x] // n for x, n in need.items())
    for x, n in need.items():
        left[x] -= n * times
        if not left[x]:
            lengths.remove(x)
    return times


def least_sequences(counts: dict[int, int], size: int) -> int:
    """A lower bound: the volume, and for every k the pieces above size - k and above half a
    sequence, with those from k to half of it that can't fill the latter's rooms."""
    best = -(-sum(x * n for x, n in counts.items()) // size)
    n, volume = np.zeros(size + 2, np.int64), np.zeros(size + 2, np.int64)
    for x, c in counts.items():
        n[x], volume[x] = c, x * c
    n, volume = np.cumsum(n), np.cumsum(volume)  # up to and with x
    half = size // 2
    for k in range(1, half + 1):
        alone, large = n[size] - n[size - k], n[size - k] - n[half]
        rooms = large * size - (volume[size - k] - volume[half])
        small = volume[half] - volume[k - 1]
        best = max(best, int(alone + large + max(0, -(-(small - rooms) // size))))
    return best


def search_report(counts: dict[int, int], size: int, limits: Limits = Limits()) -> dict[str, int | bool]:
    """Sequences used by best-fit decreasing and by the search, their lower bound, and whether the
    search ended on a limit (and not by reaching the bound or the end of its tree)."""
    state: dict[str, bool] = {}
    plan = bin_completion(counts, size, limits, state)
    return {"best_fit": sum(t for t, _ in best_fit(counts, size)), "sequences": sum(t for t, _ in plan),
            "least": least_sequences(counts, size), "limited": state.get("limited", False)}


def bin_completion(counts: dict[int, int], size: int, limits: Limits = Limits(),
                   state: dict[str, bool] | None = None) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns with multiplicities that hold all counted pieces in few sequences."""
    counts = {x: n for x, n in counts.items() if n}
    total = sum(x * n for x, n in counts.items())
    bound = least_sequences(counts, size)
    best = best_fit(counts, size)
    best_n = sum(t for t, _ in best)
    if best_n <= bound:
        return best
    # Depth first with an explicit stack; a level holds its state and the fillings not yet tried.
    start = dict(counts)
    stack = [(start, sorted(start), 0, None)]
    plan: list[tuple[int, tuple[int, ...]]] = []
    nodes = 0
    while stack and nodes < limits.nodes and best_n > bound:
        left, lengths, waste, options = stack.pop()
        if options is None:
            if not lengths:
                used = sum(t for t, _ in plan)
                if used < best_n:
                    best, best_n = list(plan), used
                if plan:
                    plan.pop()
                continue
            options = [(lengths[-1], *f) for f in fillings(_less(left, lengths[-1]), lengths, size - lengths[-1], limits)]
        if not options:
            if plan:
                plan.pop()
            continue
        own, rest = options[0], options[1:]
        nodes += 1
        stack.append((left, lengths, waste, rest))
        after, still = dict(left), list(lengths)
        times = _apply(after, still, list(own))
        lost = waste + times * (size - sum(own))
        if total + lost > (best_n - 1) * size:
            continue
        plan.append((times, own))
        stack.append((after, still, lost, None))
    if state is not None:
        state["limited"] = bool(stack) and best_n > bound
    return best


def _less(left: dict[int, int], x: int) -> dict[int, int]:
    return {**left, x: left[x] - 1}


def place_table(plan: list[tuple[int, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: ranges of ranks -> first sequence, uses, offset."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for times, own in plan:
        offset = 0
        for x in sorted(set(own), reverse=True):
            uses = own.count(x)
            rows.append((x, taken.get(x, 0), sequence, uses, offset))
            taken[x] = taken.get(x, 0) + times * uses
            offset += uses * x
        sequence += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return {"key": (cols[0] << 44) + cols[1], "rank": cols[1], "sequence": cols[2], "uses": cols[3], "offset": cols[4]}


# --- the Spark side -------------------------------------------------------------------


def pack(cut_pieces: DataFrame, size: int = SIZE, limits: Limits = Limits()) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ...)."""
    spark = cut_pieces.sparkSession
    p = cut(cut_pieces, "pack-pieces")
    counts = p.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    n = sum(r["n"] for r in counts)
    places = spark.sparkContext.broadcast(
        place_table(bin_completion({r["length"]: r["n"] for r in counts}, size, limits)))
    buckets = max(1, -(-n // BUCKET_ROWS))
    b = p.withColumn("_b", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    per = b.groupBy("_b", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("_b", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_b", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut(b.withColumn("_k", F.row_number().over(inside)).join(offsets, ["_b", "length"]).withColumn(
        "rank", F.col("_off") + F.col("_k") - 1).drop("_b", "_k", "_off"), "pack-ranks")
    cols = [c for c in ranked.columns if c != "rank"]
    schema = ranked.select(*cols, F.lit(0).cast("bigint").alias("sequence_id"),
                           F.lit(0).cast("bigint").alias("offset")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = places.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            k = np.searchsorted(t["key"], (length << 44) + rank, side="right") - 1
            at = rank - t["rank"][k]
            uses = t["uses"][k]
            where = [pa.array(t["sequence"][k] + at // uses), pa.array(t["offset"][k] + at % uses * length)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in cols] + where, [*cols, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed token sequences of pieces made ``with_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 1024 ids."""
    return pack(pieces(table(spark, sf_dir, "documents"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
