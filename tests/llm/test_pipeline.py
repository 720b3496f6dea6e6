"""Every stage of the pipeline on its own input, and the queries of the subpackage."""

import collections

import duckdb
import pytest

import corpus_pipeline
from panelkiln.llm import decontaminate, queries, toxicity

from ..conftest import DATA


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = stage(spark, docs, DATA)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "best_fit_packing":
            assert docs.columns == before.columns
        was, now = rows(before), rows(docs)
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.score(before, toxicity.fit(before, spark.read.parquet(f"{DATA}/labels.parquet"))).filter("predicted = 1").collect()}
            assert set(now) == set(was) - bad and all(now[i] == was[i] for i in now)
        elif name == "line_dedup":
            key = lambda x: x.strip(" \t\n\r\x0b\x0c").lower()
            first = {}
            for i in sorted(was):
                for x in (was[i].text or "").split("\n"):
                    first.setdefault(key(x), i)
            for i in was:
                kept = "\n".join(x for x in (was[i].text or "").split("\n") if len(key(x)) < 10 or first[key(x)] == i)
                assert now[i].text == kept if i in now else not kept.strip()
        elif name == "ngram_jaccard_join":
            sets = {}
            for i, r in was.items():
                w = (r.text or "").encode().split()
                sets[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
            root = {i: i for i in was}
            find = lambda i: i if root[i] == i else find(root[i])
            for a in was:
                for b in was:
                    if a < b and sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                        x, y = find(a), find(b)
                        root[max(x, y)] = min(x, y)
            assert set(now) == {i for i in was if find(i) == i}
        elif name == "benchmark_decontamination":
            bad = {r.doc_id for r in decontaminate.contamination(before, spark.read.parquet(f"{DATA}/benchmark.parquet")).filter("contaminated").collect()}
            assert set(now) == set(was) - bad
        else:
            assert collections.Counter(r.doc_id for r in docs.filter("piece = 0").collect()) == collections.Counter(list(was))


CLASHES = "score double, predicted int, held_out boolean, n_lines long, n_dropped long, kept_text string, rest string, _id long, _key long, _n long, kept boolean, dirty_id long, mark_bits long, found_kept boolean"


def test_stages_keep_rows_and_columns_with_clashing_names(spark):
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet").first().text
    near = [" ".join(["x" * k, *(f"near{i}" for i in range(60))]) for k in (1, 2)]
    texts = [(1, "a line that comes twice\nown words of one"), (2, "a line that comes twice\nown words of two"), (3, "\t\n a LINE that comes twice\x0b"), (4, None), (None, None), (5, ""), (6, f"before {bench} after"), (7, near[0]), (8, near[1]), (9, "again the same row here"), (9, "again the same row here"), (None, "a text without a key")]
    values = (0.25, 1, True, 3, 4, "own", "rest", 5, 6, 7, False, 8, 9, True)
    schema = f"doc_id long, text string, n_chars int, {CLASHES}"
    docs = spark.createDataFrame([(i, t, len(t or ""), *values) for i, t in texts], schema).repartition(3)
    empty = spark.createDataFrame([], schema)
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        assert stage(spark, empty, DATA).count() == 0
        got[name] = collections.Counter((r.doc_id, r.text) for r in out.collect()) if name != "best_fit_packing" else collections.Counter(r.doc_id for r in out.collect())
        if name != "best_fit_packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert all(tuple(r)[3:] == values for r in out.collect()) and all(r.n_chars == len(r.text or "") for r in out.collect())
    all_rows = collections.Counter(texts)
    assert got["toxicity"] == all_rows
    assert got["line_dedup"] == all_rows - collections.Counter([texts[1], texts[2]]) + collections.Counter([(2, "own words of two")])
    assert got["ngram_jaccard_join"] == all_rows - collections.Counter([(8, near[1]), texts[9]])
    assert got["benchmark_decontamination"] == all_rows - collections.Counter([texts[6]])
    assert got["best_fit_packing"] == collections.Counter(i for i, _ in texts)


def test_run(spark):
    out = corpus_pipeline.run(spark, DATA).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 1024
    assert {r.doc_id for r in out} <= {r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    cur = con.execute(queries.SQL[name])
    columns = [c[0] for c in cur.description]
    want = collections.Counter(map(tuple, cur.fetchall()))
    assert collections.Counter(tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, DATA).collect()) == want
