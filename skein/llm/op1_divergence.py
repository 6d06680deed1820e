"""Quality rules: distance of a document's profile from its language's reference.

Two histograms describe a text: its character classes, and its common words
(the ``common`` most frequent words of its language, and one bin for the rest).
Each language's reference is the same pair of histograms over all its
documents.  A document is rejected when the Jensen-Shannon distance (base 2) of
either pair is above its limit; a histogram made of fewer than its guard of
observations is not judged, because short samples diverge by chance.

Two passes over the texts: one counts characters and words per language (Spark
sums the tasks' counters, so a language holding most rows is no hot key), the
other profiles each document against its language's reference.  The references
of the ``MAX_LANGUAGES`` languages with most words are broadcast; those of any
others stay a table that their documents are joined to by language and a salt.

Defined results
* null or empty text: no words, all counts 0, ``base_failed`` true, kept false;
* a null language is judged against the reference of all documents;
* repeated rows are judged alike; an empty table gives no rows;
* ties among common words are broken by the word; other input columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import cut, free_prefix, slices, table

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
CLASSES = ("lower", "upper", "other_letter", "digit", "blank", "punctuation", "symbol", "other")
#: Languages whose references are broadcast; documents of others are joined to theirs.
MAX_LANGUAGES = 500
#: Entries of a task's word counter at which it is handed to Spark.
FLUSH = 200_000
#: Parts of the join of one language's documents to its reference.
SALTS = 16
ALL = "\x00all"
PROFILE = (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
           ("n_repeat_words", "long"), ("js_chars", "double"), ("js_words", "double"))


def _class_table() -> np.ndarray:
    """Character class of every code point of the first plane, from its Unicode category."""
    by = {"Ll": 0, "Lu": 1, "Lt": 1, "L": 2, "M": 2, "N": 3, "Z": 4, "P": 5, "S": 6}
    out = np.full(0x10000, 7, dtype=np.uint8)
    for c in range(0x10000):
        cat = unicodedata.category(chr(c))
        out[c] = by.get(cat, by.get(cat[0], 7))
    out[list(BLANKS)] = 4
    out[list(SYMBOLS)] = 6
    return out


_TABLE: list[np.ndarray] = []


def char_histogram(text: str) -> np.ndarray:
    """Counts per character class."""
    if not _TABLE:
        _TABLE.append(_class_table())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    astral = int(np.count_nonzero(codes >= 0x10000))
    classes = _TABLE[0][np.minimum(codes, 0xFFFF)]
    out = np.bincount(classes, minlength=len(CLASSES)).astype(np.int64)
    if astral:
        out[7] += astral
        out[_TABLE[0][0xFFFF]] -= astral
    return out


def repeated_window_words(words: list[bytes], width: int = 3) -> int:
    """Words inside ``width``-word windows that occur twice or more in the text."""
    grams = list(zip(*(words[i:] for i in range(width))))
    counts = Counter(grams) if len(set(grams)) < len(grams) else None
    if counts is None:
        return 0
    total, covered = 0, 0
    for at, gram in enumerate(grams):
        if counts[gram] > 1:
            total += at + width - max(at, covered)
            covered = at + width
    return total


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence in bits of two count vectors."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, d / 2)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str | None, Counter] = defaultdict(Counter)
    chars: dict[str | None, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES), np.int64))

    def hand_over():
        rows = [(lang, w, n) for lang, c in words.items() for w, n in c.items()]
        rows += [(lang, f" {k}", int(n)) for lang, h in chars.items() for k, n in enumerate(h) if n]
        words.clear(), chars.clear()
        langs, keys, ns = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(keys, pa.string()), pa.array(ns, pa.int64())],
            ["lang", "key", "n"])

    for part in slices(batches):
        for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            if text:
                words[lang].update(text.lower().encode("utf-8", "replace").split())
                chars[lang] += char_histogram(text)
        if sum(map(len, words.values())) > FLUSH:
            yield _decoded(hand_over, words)
    yield _decoded(hand_over, words)


def _decoded(hand_over, words) -> pa.RecordBatch:
    for c in list(words):
        words[c] = Counter({w.decode("utf-8"): n for w, n in words[c].items()})
    return hand_over()


def references(docs: DataFrame, common: int = 50) -> tuple[dict[str, tuple[np.ndarray, dict[str, int], np.ndarray]],
                                                           DataFrame | None]:
    """Per language (and for all): class counts, word -> bin, word-bin counts; and the table of
    the languages beyond ``MAX_LANGUAGES``, if there are any.

    Counted over all documents in Spark; only the ``common`` largest words of
    at most ``MAX_LANGUAGES`` languages reach the driver.
    """
    counted = docs.select("text", "lang").mapInArrow(_count, "lang string, key string, n bigint")
    per_lang = cut(counted.groupBy("lang", "key").agg(F.sum("n").alias("n")), "divergence-counts")
    is_class = F.col("key").startswith(" ")
    totals = per_lang.where(~is_class).groupBy("lang").agg(F.sum("n").alias("n"))
    own = [r["lang"] for r in totals.where("lang is not null").orderBy(
        F.col("n").desc(), "lang").limit(MAX_LANGUAGES + 1).collect()]
    beyond = len(own) > MAX_LANGUAGES
    own = own[:MAX_LANGUAGES]
    every = per_lang.groupBy("key").agg(F.sum("n").alias("n")).select(F.lit(ALL).alias("lang"), "key", "n")
    both = per_lang.where(F.col("lang").isin(own)).unionByName(every)
    top = both.where(~is_class).withColumn("_r", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.col("n").desc(), "key"))).where(F.col("_r") <= common)
    sums = {r["lang"]: r["n"] for r in both.where(~is_class).groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    refs: dict = {lang: (np.zeros(len(CLASSES)), {}, [0] * (common + 1)) for lang in sums}
    for r in both.where(is_class).collect():
        if r["lang"] in refs:
            refs[r["lang"]][0][int(r["key"])] += r["n"]
    for r in top.select("lang", "key", "n", "_r").collect():
        _, bins, counts = refs[r["lang"]]
        bins[r["key"]] = r["_r"] - 1
        counts[r["_r"] - 1] = r["n"]
    refs = {lang: (c, b, np.array([*w[:-1], sums[lang] - sum(w)], dtype=float))
            for lang, (c, b, w) in refs.items()}
    return refs, _table_of(per_lang.where(F.col("lang").isNotNull() & ~F.col("lang").isin(own)), common) if beyond else None


def _table_of(per_lang: DataFrame, common: int) -> DataFrame:
    """lang, chars, words, counts, total: one row per language of the counted words and classes."""
    is_class = F.col("key").startswith(" ")
    chars = per_lang.groupBy("lang").agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("key") == f" {k}", F.col("n"))), F.lit(0))
                  for k in range(len(CLASSES))]).alias("chars"),
        F.sum(F.when(~is_class, F.col("n"))).alias("total"))
    top = per_lang.where(~is_class).withColumn("_r", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.col("n").desc(), "key"))).where(F.col("_r") <= common)
    top = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("_r", "key", "n"))).alias("w"))
    return cut(chars.join(top, "lang").select(
        "lang", "chars", F.col("w.key").alias("words"), F.col("w.n").alias("counts"), "total"), "divergence-references")


def profile(docs: DataFrame, refs: dict, others: DataFrame | None, min_chars: int, min_words: int, carry: list[str],
            prefix: str, common: int = 50) -> DataFrame:
    """Each document's ``carry`` columns, and its counts and two distances (null below
    the guards) as columns named ``prefix`` + name."""
    shared = docs.sparkSession.sparkContext.broadcast(refs)

    def joined(lang: str, row: dict, kept: dict) -> tuple:
        """The reference in a joined row; one per language is built."""
        if lang not in kept:
            if len(kept) > 1000:
                kept.clear()
            counts = row["counts"] + [0] * (common - len(row["counts"]))
            kept[lang] = (np.array(row["chars"], float), {w.encode(): b for b, w in enumerate(row["words"])},
                          np.array([*counts, row["total"] - sum(counts)], dtype=float))
        return kept[lang]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        keyed = {k: (c, {w.encode(): b for w, b in bins.items()}, q) for k, (c, bins, q) in shared.value.items()}
        for part in slices(batches):
            rows = []
            for text, lang, row in zip(*(part.column(i).to_pylist() for i in (-3, -2, -1))):
                text = text or ""
                data = text.encode("utf-8", "replace")
                words = data.split()
                blanks = len(data) - len(data.translate(None, BLANKS))
                symbols = len(data) - len(data.translate(None, SYMBOLS))
                js_c = js_w = None
                ref = joined(lang, row, kept) if row else keyed.get(lang if lang is not None else ALL) or keyed.get(ALL)
                if ref and len(text) >= min_chars and ref[0].sum():
                    js_c = js_distance(char_histogram(text).astype(float), ref[0])
                if ref and len(words) >= min_words:
                    bins, q = ref[1], ref[2]
                    p = np.zeros(len(q))
                    hits = Counter(map(bins.get, text.lower().encode("utf-8", "replace").split()))
                    p[-1] = hits.pop(None, 0)
                    for b, n in hits.items():
                        p[b] = n
                    js_w = js_distance(p, q)
                rows.append((len(words), len(text) - blanks, symbols, duplicate_lines(text),
                             repeated_window_words(words), js_c, js_w))
            cols = list(zip(*rows)) if rows else [()] * 7
            types = [pa.int64()] * 5 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays(
                part.columns[:-3] + [pa.array(c, t) for c, t in zip(cols, types)], out.names)

    own = docs.select(*[F.col(f"`{c}`") for c in carry])
    names = [(prefix + n, t) for n, t in PROFILE]
    out = own.schema
    for n, t in names:
        out = out.add(n, t)
    both = docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias(prefix + "text"),
                       F.col("lang").alias(prefix + "lang"))
    lang, ref = F.col(prefix + "lang"), prefix + "ref"
    if others is None:
        return both.withColumn(ref, F.lit(None).cast("struct<chars:array<bigint>>")).mapInArrow(run, out)
    row = F.struct("chars", "words", "counts", "total")
    others = others.select(F.col("lang").alias(prefix + "of"), row.alias(ref),
                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(prefix + "at"))
    listed = lang.isNull() | lang.isin([k for k in refs if k != ALL])
    near = both.where(listed).withColumn(ref, F.lit(None).cast(others.schema[ref].dataType))
    far = both.where(~listed).withColumn(prefix + "salt", F.pmod(F.xxhash64(prefix + "text"), F.lit(SALTS)))
    far = far.join(others, (lang == F.col(prefix + "of")) & (F.col(prefix + "salt") == F.col(prefix + "at")), "left")
    return near.mapInArrow(run, out).unionByName(far.drop(*(prefix + c for c in ("of", "at", "salt"))).mapInArrow(run, out))


def judged(docs: DataFrame, carry: list[str], prefix: str, common: int = 50, max_js_chars: float = 0.25,
           max_js_words: float = 0.36, slack: float = 0.8, min_chars: int = 200, min_words: int = 50) -> DataFrame:
    """``carry`` columns, profile, base_failed and kept (their names behind ``prefix``).

    The word limit is ``max_js_words + slack / sqrt(n_words)``: a sample of n words
    lies about that much further from its own source than a long one.
    """
    p = profile(docs, *references(docs, common), min_chars, min_words, carry, prefix, common)
    n, x = F.col(prefix + "n_words"), lambda c: F.col(prefix + c)
    base = (n < 50) | (x("n_repeat_words") * 100 > n * 50)
    far = (F.coalesce(x("js_chars"), F.lit(0.0)) > max_js_chars) | (
        F.coalesce(x("js_words"), F.lit(0.0)) > max_js_words + slack / F.sqrt(n))
    return p.withColumns({prefix + "base_failed": base, prefix + "kept": ~base & ~far})


def quality_rules(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, counts, base_failed, kept, js_chars, js_words for (doc_id, text, lang)."""
    prefix = "q_"
    out = judged(docs.select(F.col("doc_id").cast("bigint"), "text", "lang"), ["doc_id"], prefix, **limits)
    return out.select("doc_id", *[F.col(prefix + c).alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "js_chars", "js_words")])


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are."""
    prefix = free_prefix(docs.columns)
    out = judged(docs, docs.columns, prefix, **limits)
    return out.where(F.col(prefix + "kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile every document and judge it against its language."""
    return quality_rules(table(spark, sf_dir, "documents"))
