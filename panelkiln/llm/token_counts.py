"""Delta-maintained token counts by source, language and tokenizer version.

The store holds one folder of signed totals for each committed batch: inserts add, deletes subtract, and a revised
count adds its difference. A batch is aggregated on the executors and written under its own identifier, so committing
it again replaces the same totals with the same totals (a batch marked complete is left alone), and a batch whose job
died half-way is simply written again. Totals are the sum over batches; compact() folds many batches into one and keeps
their names beside its own totals, so that a batch folded in is not added again; names count once the totals are complete.

Defined results: a null source or language is a group of its own. A null text has 0 tokens and counts as a document.
Counts that cancel to no documents and no tokens leave no row. An empty batch commits nothing but its mark. Changes
with a null count add 0. Of rows with equal texts the smallest doc_id stays (null before all), then the smallest source and
language, so repeated rows count once and totals do not depend on the order of files. All tokens of a very long text
count. Other columns play no part.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import settle, shared_folder
from .tokens import CHUNK_BYTES, Ids, vocabulary_path

#: Folder of compact(): below it, for each batch of folded totals, a marker for each batch folded into it.
FOLDED = "_folded"
KEYS = ["source", "lang", "tokenizer"]
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def count_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, source, lang, text_key, bpe, words): tokens of each whole text in two tokenizer versions."""
    path = vocabulary or vocabulary_path()

    def run(batches):
        tokens = Ids(path)
        for t in K.chunks(batches, limit=CHUNK_BYTES):
            buf, offsets = K.string_buffers(t.column("text"))
            words = np.diff(K.spans(K.SPACES[buf], offsets)[2])
            _, first = tokens.of(t.column("text"))
            yield from t.drop_columns(["text"]).append_column("bpe", pa.array(np.diff(first))).append_column("words", pa.array(words.astype(np.int64))).to_batches()

    picked = docs.select("doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_key"), "text")
    schema = ", ".join(f"{c} {kind}" for c, kind in picked.dtypes if c != "text")
    return picked.mapInArrow(run, f"{schema}, bpe long, words long")


class Rollup:
    """Totals under a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _below(self, path: str) -> list[str]:
        if not self._exists(path):
            return []
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return sorted(x.getPath().toString() for x in p.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(p))

    def _folders(self) -> list[str]:
        return [x for x in self._below(self.path) if self._exists(f"{x}/_SUCCESS")]

    def batches(self) -> list[str]:
        """Names of all batches committed, folded ones too."""
        own = [x.rsplit("/batch=", 1)[1] for x in self._folders()]
        return sorted({*own, *(x.rsplit("/batch=", 1)[1] for name in own for x in self._below(f"{self.path}/{FOLDED}/into={name}"))})

    def _remember(self, batch: str, into: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{FOLDED}/into={into}/batch={batch}")
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(p)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds changes (KEYS, old_tokens, new_tokens: null old inserts, null new deletes); False if the batch is already in."""
        at = f"{self.path}/batch={batch}"
        if batch in self.batches():
            return False
        sign = F.col("new_tokens").isNotNull().cast("long") - F.col("old_tokens").isNotNull().cast("long")
        more = F.coalesce("new_tokens", F.lit(0)) - F.coalesce("old_tokens", F.lit(0))
        totals = changes.groupBy(*KEYS).agg(F.sum(sign).alias("n_docs"), F.sum(more).cast("long").alias("n_tokens"))
        totals.write.mode("overwrite").parquet(at)
        return True

    def totals(self) -> DataFrame:
        folders = self._folders()
        rows = self.spark.read.schema(TOTALS).parquet(*folders) if folders else self.spark.createDataFrame([], TOTALS)
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter("n_docs <> 0 or n_tokens <> 0")


def compact(rollup: Rollup, path: str, batch: str) -> Rollup:
    """The same totals as one batch of a new store, which knows the names of the batches folded in. The totals' own commit
    makes both count, so a run that died half-way leaves an empty store and is simply repeated."""
    out = Rollup(rollup.spark, path)
    for name in rollup.batches():
        out._remember(name, batch)
    rollup.totals().write.mode("overwrite").parquet(f"{out.path}/batch={batch}")
    return out


def _as_changes(counts: DataFrame, old: dict | None, new: dict | None) -> DataFrame:
    """One change per tokenizer version; old, new: the count column of each version."""
    none = F.lit(None).cast("long")
    versions = [F.struct(F.lit(v).alias("tokenizer"), (F.col(old[v]) if old else none).alias("old_tokens"), (F.col(new[v]) if new else none).alias("new_tokens")) for v in (old or new)]
    return counts.select("source", "lang", F.explode(F.array(*versions)).alias("c")).select("source", "lang", "c.*")


VERSIONS = {"byte_bpe_50k": "bpe", "white_space_1": "words"}


def corpus_rollup(docs: DataFrame, store: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """Totals after four commits: all documents enter; white_space counts are revised to include one closing token per
    text (version white_space_1); exact copies, but the smallest doc_id of each text, are deleted; and the first batch is
    committed once more, which changes nothing."""
    spark = docs.sparkSession
    counts = settle(count_tokens(docs, vocabulary), "counts").withColumn("closed", F.col("words") + 1)
    # of each text, the row with the smallest doc_id stays: all rows are deleted and those inserted again, in one batch,
    # so no join brings all copies of a text together
    first = counts.groupBy("text_key").agg(F.min(F.struct("doc_id", "source", "lang", *sorted(set(VERSIONS.values()) | {"closed"}))).alias("first")).select("first.*")
    rollup = Rollup(spark, store or f"{shared_folder(spark)}/panelkiln/rollup-{uuid.uuid4().hex}")
    after = VERSIONS | {"white_space_1": "closed"}
    load = _as_changes(counts, None, VERSIONS)
    rollup.commit("0001-load", load)
    rollup.commit("0002-revise", _as_changes(counts, {"white_space_1": "words"}, {"white_space_1": "closed"}))
    rollup.commit("0003-copies", _as_changes(counts, after, None).unionByName(_as_changes(first, None, after)))
    rollup.commit("0001-load", load)
    return rollup.totals()
