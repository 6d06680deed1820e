"""The corpus pipeline: from raw documents to packed training sequences.

1. quality      rows that the divergence rules reject go (op 1)
2. duplicates   one document of each near-duplicate component stays, the one with the
                smallest id: 5-word shingles, Jaccard similarity of 0.8 or more (op 5)
3. private      personal data is replaced by its kind in brackets (op 9)
4. mix          sources are repeated or sampled to their target weights (op 2)
5. pack         the mix is packed into sequences of 1024 tokens (op 4)

Each stage works on all that the one before it kept.  All but the last return the
columns of ``documents`` (and any extra columns they came with).

Defined results: null texts fail the quality rules; rows that share a doc_id are
one document to the duplicate stage and stay or go together; a row without a doc_id
is linked with nothing and stays; an empty table gives an empty result.  The quality references and the mix are computed from the rows
that reach their stage, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import cut, table
from skein.llm.op1_divergence import keep_good
from skein.llm.op2_mix import mixed
from skein.llm.op4_pack import pack, pieces
from skein.llm.op5_ngram_join import BROADCAST_IDS, near_duplicates
from skein.llm.op9_pii import redact


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    found = near_duplicates(docs, width=5, percent=80)
    gone = cut(found.where("doc_id != component_id").select("doc_id").distinct(), "pipeline-gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their personal data; n_chars follows the text."""
    out = redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the capped source weights say."""
    return mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece's place in the packed sequences."""
    return pack(pieces(docs)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality", quality),
    ("duplicates", duplicates),
    ("private", private),
    ("mix", mix),
    ("pack", packed),
]

#: The stages hold hashes, message passing and a search, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
