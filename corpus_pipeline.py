"""A corpus made ready for training, stage by stage.

Each stage takes all rows the one before it kept, and its decisions take effect. What a stage
returns is written to the shared folder and read again as the next stage's documents; once that
stage is written, the one before it is removed. All but the last keep the columns of documents, extra ones included.

Defined results: null, empty and wordless texts have no letter, so the first stage rejects
them. Equal texts keep one row (largest id), near duplicates one row (smallest id), and the mix
may take a row twice or not at all. Rows that agree in id and text are one document. Texts of any
length pass whole through every stage. An empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablehaul.llm.common import documents
from tablehaul.llm.exact_dedup import without_copies
from tablehaul.llm.language_id import identified
from tablehaul.llm.mixing import mixture
from tablehaul.llm.sentence_pieces import encoded
from tablehaul.llm.simhash import without_near_duplicates
from tablehaul.sources.files import delete, fresh_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear."""
    return identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return without_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near duplicates."""
    return without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece numbers of every text, checked by decoding them."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encoded(docs, path).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: SQL has neither compression nor the pieces' lattices; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs, before = documents(spark, sf_dir), None
    for i, (_, stage) in enumerate(STAGES):
        made, uri = stage(spark, docs, sf_dir), fresh_folder(spark, f"stage-{i}")
        made.write.parquet(uri)
        docs = spark.read.schema(made.schema).parquet(uri)
        if before is not None:
            delete(spark, before)
        before = uri
    return docs
