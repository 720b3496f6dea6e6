"""Bounds that repeated rows must not break, results that must not depend on file layout, and prefixes that get shorter."""

import collections
import tracemalloc
import zlib

import numpy as np
import pytest

from panelkiln.llm import blocks, ngram_join, pseudo_likelihood, token_counts, toxicity


def test_training_rows_are_bounded_in_rows_and_bytes(spark, monkeypatch):
    rows = [(i, f"plain words number {i} of many") for i in range(400)] + [(0, f"again {i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(400)], "doc_id long, toxic int")
    seen = []
    plain = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda a, b, *more: seen.append((a, b)) or plain(a, b, *more))
    both = [toxicity.fit(docs.repartition(n), labels, bits=12, most_positive=50, most_unlabelled=70) for n in (2, 7)]
    assert [(len(a), len(b)) for a, b in seen] == [(50, 70)] * 2
    assert (both[0]["weights"] == both[1]["weights"]).all() and both[0]["bias"] == both[1]["bias"]
    # doc_id 0 trains (crc32 of "0" is 4108050209), and its 3,001 rows come before or after all others
    toxicity.fit(docs, labels, bits=12, most_positive=4000, most_unlabelled=5000)
    own = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    assert len(seen[2][0]) == sum(i < 200 for i, _ in own) and len(seen[2][1]) == min(5000, len(own))
    toxicity.fit(docs, labels, bits=12, most_positive=4000, most_unlabelled=5000, most_bytes=400)
    for part in seen[3]:
        assert 0 < len(part) < 20 and 4 * sum(map(len, part)) <= 400
    toxicity.fit(docs, labels, bits=12, most_bytes=1)
    assert [len(x) for x in seen[4]] == [1, 1]


def test_training_takes_little_of_the_drivers_memory():
    rng = np.random.default_rng(1)
    draw = lambda low: np.unique(rng.integers(low, low + 600, 100))
    toxic, others = [draw(0) for _ in range(60)], [draw(300) for _ in range(90)]
    tracemalloc.start()
    weights, _ = toxicity.train(toxic, others, 0.2, 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # the weights take 8 MB; tables of all features in double precision, side by side, took over 60
    assert peak < 40e6
    assert weights[:300].mean() > weights[600:900].mean() and not weights[900:].any()


@pytest.mark.parametrize("shift", [-3.0, 3.0])
def test_risk_and_slope_equal_a_brute_force_version(shift):
    rng = np.random.default_rng(3)
    pos, prior = rng.random(40) < 0.3, 0.2
    logit = rng.normal(size=40) + shift * pos  # the bracket is negative in one case: positives look clean there

    def parts(z):
        s = [1 / (1 + np.exp(-x)) for x in z]
        on_pos = [i for i in range(40) if pos[i]]
        off = [i for i in range(40) if not pos[i]]
        toxic = prior * sum(-np.log(s[i]) for i in on_pos) / len(on_pos)
        bracket = sum(-np.log(1 - s[i]) for i in off) / len(off) - prior * sum(-np.log(1 - s[i]) for i in on_pos) / len(on_pos)
        return toxic, bracket

    for z in (logit, logit + 4 * pos - 3 * ~pos):
        toxic, bracket = parts(z)
        aim = (lambda x: sum(parts(x))) if bracket >= 0 else (lambda x: -parts(x)[1])
        risk, slope = toxicity.risk_and_slope(1 / (1 + np.exp(-z)), pos, prior)
        assert abs(risk - (toxic + max(0, bracket))) < 1e-9
        step = np.eye(40) * 1e-5
        assert np.abs(slope - [(aim(z + d) - aim(z - d)) / 2e-5 for d in step]).max() < 1e-6
    assert parts(logit + 4 * pos - 3 * ~pos)[1] < 0 or shift < 0


def test_totals_do_not_depend_on_the_order_of_rows(spark):
    rows = [(1, "b", "fr", "same text"), (1, "a", "en", "same text"), (None, "d", "de", "other"), (None, "c", "en", "other"), (None, "c", "en", "other")]
    got = []
    for these, parts in ((rows, 1), (rows[::-1], 1), (rows, 4)):
        docs = spark.createDataFrame(these, "doc_id long, source string, lang string, text string").repartition(parts)
        got.append(collections.Counter((r.source, r.lang, r.tokenizer, r.n_docs) for r in token_counts.corpus_rollup(docs).collect()))
    assert got[0] == got[1] == got[2] and {k[:2] for k in got[0]} == {("a", "en"), ("c", "en")} and all(k[3] == 1 for k in got[0])


def test_compaction_that_died_half_way_is_repeated(spark, tmp_path):
    change = spark.createDataFrame([("s", "en", "v", None, 5)], "source string, lang string, tokenizer string, old_tokens long, new_tokens long")
    r = token_counts.Rollup(spark, str(tmp_path / "r"))
    assert r.commit("a", change) and r.commit("b", change)
    small = token_counts.Rollup(spark, str(tmp_path / "small"))
    small._remember("a", "ab")  # names are there, totals are not
    assert small.batches() == [] and small.totals().count() == 0
    small = token_counts.compact(r, str(tmp_path / "small"), "ab")
    assert small.batches() == ["a", "ab", "b"] and not small.commit("b", change)
    again = token_counts.compact(small, str(tmp_path / "again"), "c")
    assert again.batches() == ["a", "ab", "b", "c"] and [tuple(x)[3:] for x in again.totals().collect()] == [(2, 10)]


def test_kept_twins_do_not_depend_on_the_order_of_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "b", None, {"k": 1}), (1, text, "a", 2.5, {"k": 2}), (1, text, "a", None, {"k": 2}), (None, text + " x", "c", 1.0, None), (None, text + " x", "b", 1.0, None), (2, "", "y", 1.0, None), (2, "", "x", 1.0, None)]
    got = []
    for these, parts in ((rows, 1), (rows[::-1], 1), (rows, 5)):
        docs = spark.createDataFrame(these, "doc_id long, text string, extra string, x double, m map<string,int>").repartition(parts)
        got.append(sorted(((r.doc_id, r.extra, r.x, str(r.m)) for r in ngram_join.one_of_each(docs).collect()), key=str))
    assert got[0] == got[1] == got[2] and len(got[0]) == 3 and sum(r[0] == 1 and r[1] == "a" for r in got[0]) == 1


def drifting(edits: tuple[int, int], groups: int, versions: int) -> list[tuple[int, str]]:
    rng, rows = np.random.default_rng(8), []
    for g in range(groups):
        w = [f"g{g}t{x}" for x in range(160)]
        for c in range(versions):
            for e in range(int(rng.integers(*edits))):
                w[int(rng.integers(0, 160))] = f"g{g}c{c}e{e}"
            rows.append((len(rows), " ".join(w)))
    return rows


def test_prefixes_get_shorter_until_enough_pairs_meet(spark, monkeypatch):
    depths, plain = [], ngram_join._lead
    monkeypatch.setattr(ngram_join, "_lead", lambda least, depth, trees: depths.append(depth) or plain(least, depth, trees))
    hard = spark.createDataFrame(drifting((2, 4), 30, 12), "doc_id long, text string")
    # copies with one changed word: far above the threshold, so the first depth is enough
    easy = spark.createDataFrame([(10 * g + c, " ".join([f"v{c}", *(f"g{g}t{x}" for x in range(160))])) for g in range(60) for c in range(4)], "doc_id long, text string")

    def links(docs, **settings):
        depths.clear()
        n = sum(r.n_links for r in ngram_join.near_texts(docs, **settings).collect())
        return n, list(depths)

    assert links(easy)[1] == [5] and links(easy)[0] == 60 * 4 * 3
    few, one = links(hard, trees=4, recall=0.7, target=0.0)
    more, several = links(hard, trees=4, recall=0.7, target=0.97)
    assert len(one) == 1 and len(several) > 1 and several == list(range(one[0], several[-1] - 1, -1))
    assert more > few


def test_the_estimate_is_the_share_of_pairs_that_meet():
    # two sets of similarity s agree in each value of a signature with chance s; a branch for each tree where they meet
    rng, trees, depth = np.random.default_rng(4), 4, 4
    s = rng.choice([0.8, 0.85, 0.95], 40_000)
    meets = (rng.random((len(s), trees, depth)) < s[:, None, None]).all(2)
    at = np.repeat(s, meets.sum(1))
    pairs = 1 / (trees * at**depth)
    estimate = (pairs * ngram_join.chance(at, depth, trees)).sum() / pairs.sum()
    assert abs(estimate - meets.any(1).mean()) < 0.01 and estimate < 0.95


def test_buckets_grow_with_replicated_bytes(spark):
    from pyspark.sql import functions as F

    rows = spark.range(1000).select((F.col("id") % 5).alias("g"), "id")
    few = blocks.block_pairs(rows, ["g"], F.col("id"), 1000, 3, F.lit(10))
    assert few.count() == 1000 and few.agg(F.max("bucket")).first()[0] < 3
    many = blocks.block_pairs(rows, ["g"], F.col("id"), 50, 3, F.lit(10), each=400)
    assert many.count() == 4000 and many.agg(F.max("bucket")).first()[0] >= 50  # 40,000 replicated bytes: 100 buckets


@pytest.mark.parametrize("parts", [1, 51, 1875, 1 << 24])
def test_keys_are_ranked_as_by_a_plain_sort(parts):
    rng = np.random.default_rng(parts)
    for n in (1, 2, 3, 5000):
        keys = (rng.integers(0, parts, n).astype(np.uint64) << np.uint64(32)) | rng.integers(2**32 - 50, 2**32, n).astype(np.uint64)
        by, number = pseudo_likelihood._ranked(keys, parts)
        got = np.empty(n, np.int64)
        got[by] = number
        assert sorted(by) == list(range(n)) and (got == np.unique(keys, return_inverse=True)[1]).all()


def test_softmax_equals_a_plain_one():
    s = np.random.default_rng(2).normal(0, 20, (300, 13)).astype(np.float32)
    s[0, 1:] = -30.0
    want = np.exp(s.astype(float) - s.max(1, keepdims=True))
    assert np.abs(pseudo_likelihood._softmax(s.copy()) - want / want.sum(1, keepdims=True)).max() < 1e-6
