"""From raw documents to token ids: the stages in order, each over all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import lines, minhash, mixing, pieces, toxicity
from ticketmill.llm.frames import pick, ship, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay, as they are, repeated rows each by itself.

    Null and empty texts score as texts without a match and stay; texts of any length are scored
    whole. Without labelled toxic documents nothing is learned and all stay. An empty table gives
    an empty one; columns beside those of documents go.
    """
    ship(spark)
    docs = pick(docs, *COLUMNS)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = toxicity.toxic_score(model, F.col("text"))
    return docs.withColumn("score", score).where("score < 0.5").drop("score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines leave the text, but for the document of the largest id; n_chars follows the text.

    A null text becomes an empty one. Every row stays, also one whose lines all go; rows that
    repeat an id are the same document to the count and are each cleaned. A null id holds no line
    for others and loses shared ones. An empty table gives an empty one; texts are read whole.
    """
    cleaned = pick(lines.drop_shared_lines(pick(docs, *COLUMNS)), *COLUMNS)
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the smallest id: five-word shingles, similarity of 0.8 or
    more, confirmed on whole texts.

    Texts without words (null, empty, blank) link to nothing and stay, as do rows without id. Rows
    that repeat an id are one document: they stay or go together. Ties cannot occur, and an empty
    table gives an empty one.
    """
    return minhash.one_of_each(pick(docs, *COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, three times at most, or not at all.

    A null source is one of its own. Texts without words weigh nothing and are taken as their place
    in the seeded order says. Repeated rows are documents each. An empty table gives an empty one.
    """
    return mixing.repeated(pick(docs, *COLUMNS))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with the digests that the encoding and decoding are checked by, a row per row.

    A null text is an empty one: its end id alone. Texts of any length are encoded whole.
    """
    return pieces.encode(docs, parts=("ids",))


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece),
]

#: Learned scores, signatures and token ids have no SQL form; a test runs the stages one after the
#: other and holds each against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
