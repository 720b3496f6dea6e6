"""The corpus pipeline: documents through five of the operators, each stage written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkiln.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from panelkiln.llm.common import shared_folder, table


def _with_rest(docs: DataFrame) -> tuple[DataFrame, tuple]:
    """(doc_id, text, rest): all other columns in one struct, so that no name of theirs can meet an operator's own."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", *([F.struct(*rest).alias("rest")] if rest else [])), ("rest",) * bool(rest)


def _spread(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, in their order and with their types, from (doc_id, text, rest)."""
    return df.select(*(F.col(c if c in ("doc_id", "text") else f"rest.`{c}`").cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold; labels come from sf_dir.

    A null or empty text gets the score of a text without words. Rows with a null doc_id and repeated rows are judged by
    their texts like others. Further columns stay, whatever their names. An empty table stays empty.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    both, rest = _with_rest(docs)
    return _spread(toxicity.score(both, model, keep=("text", *rest)).filter("predicted = 0"), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document holds; n_chars follows the text.

    A document that loses lines and keeps nothing but white space goes; one that was null or empty stays as it was. A
    null doc_id sorts before all others, and rows that share a doc_id are one document: a repeated row loses nothing
    to its twin. Further columns stay, whatever their names. An empty table stays empty.
    """
    both, rest = _with_rest(docs)
    kept = line_dedup.drop_lines(both, keep=rest).withColumn("text", F.col("kept_text"))
    kept = kept.filter((F.col("n_dropped") == 0) | (F.trim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\x0c\r")) != ""))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("rest", F.col("rest").withField("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("rest.n_chars"))))
    return _spread(kept, docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id (nulls last).

    A null or blank text is no copy of another and stays. Of repeated rows one stays. Further columns stay, whatever
    their names. An empty table stays empty.
    """
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window.

    A null or empty text holds none. Repeated rows and rows with a null doc_id are judged by their texts. Further columns
    stay, whatever their names. An empty table stays empty.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences.

    A null or empty text is its closing id. Each row is a document of its own, repeated or without doc_id. Further columns
    play no part. An empty table gives no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: Trained scores, tokenizer ids and bin packing have no SQL form; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, at = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/panelkiln/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            out.write.parquet(f"{at}/{i}-{name}")
            out = spark.read.parquet(f"{at}/{i}-{name}")
        docs = out
    return docs
