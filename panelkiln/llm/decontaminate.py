"""Benchmark decontamination with DataFrame functions only.

Windows of benchmark words form a hash set by their first words. The hashes of a document's places are exploded
against it (a broadcast hash join while the set's counted size is under `broadcast_bytes`, else a shuffled join of the
places that may hit), hits are verified word by word against the window's own text, and the covered words are counted
by merging hit intervals.

Defined results: a null or empty text has no words, no hits and is not contaminated. Rows with a null doc_id are
documents like others. A repeated row gets its own, equal result. A null, empty or repeated benchmark item adds no
window, or the same windows. A very long text is scanned whole. Other columns of either table play no part, whatever
their names, and decontaminate() keeps those of the documents. Empty tables give empty results, or no hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import may_meet
from .common import free, settle

#: What lies between words of a lower-cased text, and of one that is not.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: First words of a window that are hashed to find it.
ANCHOR = 3
#: Bytes of the window set (texts, item_ids and 100 a window) up to which it is broadcast.
BROADCAST_BYTES = 100 << 20


def words(text: F.Column) -> F.Column:
    text = F.coalesce(text, F.lit(""))
    # lower() changes letters beyond A-Z too, but is much faster where there are none
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, GAP), "")


def benchmark_windows(benchmark: DataFrame, n: int = 10) -> DataFrame:
    """(item_id, k, h, phrase): each window of n words, or the whole item where it has fewer."""
    t = benchmark.select("item_id", words(F.col("text")).alias("t")).filter(F.size("t") > 0).withColumn("k", F.least(F.size("t"), F.lit(n)))
    w = t.select("item_id", "k", F.explode(F.expr("transform(sequence(1, size(t) - k + 1), i -> slice(t, i, k))")).alias("w"))
    return w.select("item_id", "k", F.xxhash64("w").alias("h"), F.array_join("w", " ").alias("phrase")).distinct()


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = 10, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, key, k, n_words, at, items): each verified occurrence of a window, and one row per document with at = -1.

    One scan serves windows of all lengths: every place of a document gets the hash of its next ANCHOR words (fewer
    for shorter windows), and only places whose hash is a window's are verified word by word. The document's own row
    comes out of the same scan: the window set holds a marker that each document's list of hashes starts with.
    """
    spark = docs.sparkSession
    windows = settle(benchmark_windows(benchmark, n).groupBy("k", "h", "phrase").agg(F.collect_set("item_id").alias("items")), "windows")
    size = windows.agg(F.sum(F.octet_length("phrase") + 16 * F.size("items").cast("long") + 100)).first()[0] or 0
    firsts = F.split("phrase", " ")
    lengths = sorted({min(r.k, ANCHOR) for r in windows.select("k").distinct().collect()}, reverse=True)  # n rows at most
    anchor = F.lit(None).cast("long")
    for m in lengths:
        anchor = F.when(F.least("k", F.lit(ANCHOR)) == m, F.xxhash64(*(F.get(firsts, F.lit(j)) for j in range(m)))).otherwise(anchor)
    item = dict(benchmark.dtypes)["item_id"]
    marker = spark.range(1).select(F.lit(0).cast("long").alias("h"), F.lit(None).cast("string").alias("phrase"), F.lit(0).alias("k"), F.expr(f"cast(array() as array<{item}>)").alias("items"))
    side = windows.select(anchor.alias("h"), "phrase", "k", "items").unionByName(marker)
    t = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), words(F.col("text")).alias("t"))
    same = (F.col("at") == -1) & F.col("phrase").isNull() | (F.col("at") >= 0) & (F.array_join(F.slice("t", F.greatest("at", F.lit(0)) + 1, F.col("k")), " ") == F.col("phrase"))
    hashes = [F.when(F.col("at") < 0, 0).otherwise(F.xxhash64(*(F.get("t", F.col("at") + j) for j in range(m)))) for m in lengths or [1]]

    def placed(*more):
        # the list is no bare column, so that Spark does not filter on it first and make it twice
        every = t.select("doc_id", "key", "t", F.posexplode(F.concat(F.array(F.lit("")), "t")).alias("place", "_")).withColumn("at", F.col("place") - 1)
        if len(hashes) > 1:
            every = every.withColumn("h", F.explode(F.when(F.col("at") < 0, F.array(F.lit(0).cast("long"))).otherwise(F.array(*hashes))))
        else:
            every = every.withColumn("h", hashes[0])
        return every.select("doc_id", "key", F.size("t").alias("n_words"), *more, "at", "h")

    if size <= broadcast_bytes:
        met = placed("t").join(F.broadcast(side), "h")
    else:
        # places are shuffled without their document's words; those come back for the hits alone
        met = may_meet(placed(), "h", side, "h").join(side, "h")
        own = t.dropDuplicates(["doc_id", "key"]).toDF("_id", "_key", "t")
        met = met.join(own, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    return met.filter(same).select("doc_id", "key", "k", F.col("n_words").cast("long").alias("n_words"), "at", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and key and spans for removal.

    spans: disjoint intervals [start, end) of hit words. A document's rows are as many as its hits; they are first
    cut to distinct places, and intervals merge in a window over one document only.
    """
    hits = find_hits(docs, benchmark, n, broadcast_bytes)
    one = Window.partitionBy("doc_id", "key").orderBy("at", "k")
    end = F.col("at") + F.col("k")
    reach = F.coalesce(F.max(F.when(F.col("at") >= 0, end)).over(one.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a repeated row repeats its marker and its hits: copies counts the markers, and a place counts once
    placed = hits.groupBy("doc_id", "key", "n_words", "at", "k").agg(F.count("*").alias("copies"), F.flatten(F.collect_set("items")).alias("items"))
    merged = placed.withColumn("from", F.greatest("at", reach)).withColumn("new", F.when(F.col("at") >= 0, F.greatest(end - F.col("from"), F.lit(0))).otherwise(0))
    per = merged.groupBy("doc_id", "key", "n_words").agg(
        F.max(F.when(F.col("at") < 0, F.col("copies"))).alias("copies"),
        F.sum("new").cast("long").alias("n_hit"),
        F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_set("items"))), lambda x: x.cast("string"))).alias("items"),
        F.array_sort(F.collect_list(F.when(F.col("new") > 0, F.struct(F.col("from").cast("int").alias("start"), end.cast("int").alias("end"))))).alias("spans"),
    )
    return per.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "key", "spans", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """docs without contaminated documents (remove="documents"), or with the hit words cut out of them (remove="spans").

    All columns and all clean rows stay as they are, also rows with a null doc_id.
    """
    found = contamination(docs, benchmark, n, broadcast_bytes).filter("contaminated").select("doc_id", "key", "spans").dropDuplicates(["doc_id", "key"])
    own_id, own_key, spans = free(docs, "dirty_id", "dirty_key", "dirty_spans")
    # a table of its own: Spark knows its size, broadcasts it where it is small and shuffles the texts only beyond
    dirty = settle(found if remove == "spans" else found.drop("spans").withColumn("spans", F.lit(None)), "dirty").toDF(own_id, own_key, spans)
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(own_key))
    if remove == "documents":
        return docs.join(dirty.drop(spans), same, "left_anti")
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    both = docs.join(dirty, same, "left")
    w, gaps = F.array_remove(F.split("text", RAW_GAP), ""), F.split("text", RAW_WORD)
    kept = F.concat(F.element_at(gaps, 1), F.array_join(F.transform(w, lambda x, i: F.when(F.exists(spans, lambda s: (s["start"] <= i) & (i < s["end"])), F.lit("")).otherwise(F.concat(x, F.get(gaps, i + 1)))), ""))
    return both.withColumn("text", F.when(F.col(own_key).isNotNull(), kept).otherwise(F.col("text"))).select(docs.columns)
