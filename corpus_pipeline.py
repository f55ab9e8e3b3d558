"""From raw documents to sampled training pieces, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes what a stage
returns as Parquet in the shared folder and hands the files to the next.  All
stages but the last return the columns of the documents they got.  Every stage
takes null values, empty and repeated rows, empty tables and further columns of
any name; what its operator returns for them is in the operator's docstring.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentmart.llm import exact_dedup, langid, mixing
from incidentmart.llm.common import fresh, stage
from incidentmart.llm.jaccard_join import keep_one
from incidentmart.llm.piece_sampling import encode_sampled
from incidentmart.llm.queries import language_model, mixed, table

MODEL = "piece_bpe_32k.model"
SEED = 0


def _aside(docs: DataFrame, made: list[str]) -> tuple[DataFrame, list]:
    """``docs`` with columns that an operator would replace set aside, and the columns that bring them back."""
    taken = [c for c in docs.columns if c.lower() in {m.lower() for m in made}]
    clash = dict(zip(taken, fresh([*docs.columns, *made], *[f"own_{c}" for c in taken])))
    return docs.withColumnsRenamed(clash), [F.col(f"`{clash.get(c, c)}`").alias(c) for c in docs.columns]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; ``lang`` becomes the predicted one, rejected documents go."""
    model = language_model(docs)
    rows, own = _aside(docs, langid.OUT)
    found = langid.identify_language(rows, model).filter("NOT rejected")
    return found.withColumn("lang", F.col("lang_pred")).select(*own)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    rows, own = _aside(docs, exact_dedup.OUT)
    return exact_dedup.exact_dedup(rows).filter("kept").select(*own)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts (five-word shingles, similarity 0.8)."""
    return keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: sources weigh 3, 1, 2, and share 150 % of all words, at most twice their own."""
    rows, own = _aside(docs, mixing.OUT)
    taken = mixed(rows).filter("repeats > 0")
    copy, = fresh(taken.columns, "copy")
    return taken.withColumn(copy, F.explode(F.expr("sequence(1L, repeats)"))).select(*own)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' other columns with sampled SentencePiece ids instead of the text."""
    others = [c for c in docs.columns if c.lower() not in ("text", "pieces", "n_pieces")]
    coded = encode_sampled(docs, public_tokenizers.path(MODEL), seed=SEED, columns=others)
    return coded.withColumn("n_pieces", F.coalesce(F.size("pieces"), F.lit(0)).cast("long"))


STAGES = [
    ("language_id", identify),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix),
    ("piece_sampling", encode),
]

# Trained models and sampled similarity search have no SQL form; tests/llm hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
