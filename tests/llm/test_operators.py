"""Each operator against a brute-force version on a small table of edge cases, and on empty tables."""

import collections
import hashlib
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from panelkiln.llm import blocks, common, decontaminate, kernels, line_dedup, ngram_join, packing, pseudo_likelihood, sharding, substring_dedup, token_counts, tokens, toxicity, vector_dedup

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PASSAGE = " ".join(f"word{i}" for i in range(30))
OTHER = " ".join(f"Other{i}." for i in range(60))
LONG = " ".join(f"tok{i % 977}x{i // 500}" for i in range(30000))
ROWS = [
    (0, f"alpha beta {PASSAGE} gamma\nA line that repeats here\n  short \n", "en"),
    (1, f"delta {PASSAGE} epsilon\n\ta LINE that repeats here \nshort", None),
    (2, None, "en"),
    (3, "", "fr"),
    (4, " \t\n\x0b ", "fr"),
    (5, "three words only", "de"),
    (6, "three words only", "de"),
    (7, OTHER, "en"),
    (8, OTHER + " tail", "en"),
    (9, OTHER, "en"),
    (10, LONG, "en"),
    (11, "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a", "en"),
    (12, "Élan vital — ñandú 東京 text end", "es"),
    (13, f"line one is long enough\nline one is long enough\n{PASSAGE}", "en"),
    (None, f"{PASSAGE} without a key", "en"),
    (15, "repeated row of this table", "en"),
    (15, "repeated row of this table", "en"),
]
SCHEMA = "doc_id long, text string, lang string, source string, bucket int, key string, label int, n long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, la, f"s{(i or 0) % 3}", 1, "k", None, 5) for i, t, la in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(df, *columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in df.collect())


def order(i):
    return (i is not None, i or 0)


def test_word_hashes_do_not_depend_on_chunks():
    a = kernels.words_of(pa.array([r[1] for r in ROWS]))[0]
    b = np.concatenate([kernels.words_of(pa.array([r[1]], pa.string()))[0] for r in ROWS])
    assert (a == b).all() and len(a) == sum(len((r[1] or "").encode().split()) for r in ROWS)


def test_decontamination(spark, docs, empty):
    item = " ".join(f"WORD{i}" for i in range(5, 25))
    bench = spark.createDataFrame([(1, item, "x"), (2, "Three, words", "x"), (3, None, "x"), (4, "", "x"), (10, item, "x")], "item_id long, text string, doc_id string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for i, t in ((1, item), (2, "Three, words"), (10, item)):
        w = word.findall(t.translate(LOW))
        k = min(10, len(w))
        for p in range(len(w) - k + 1):
            windows[tuple(w[p : p + k])].add(i)
    want = collections.Counter()
    dirty = set()
    for i, t, _ in ROWS:
        w, hit, items = word.findall((t or "").translate(LOW)), set(), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if found := windows.get(tuple(w[p : p + k])):
                    items |= found
                    hit |= set(range(p, p + k))
        want[(i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest(), bool(hit))] += 1
        dirty |= {i} if hit else set()
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert counted(decontaminate.contamination(docs, bench), *columns) == want
    assert counted(decontaminate.contamination(docs, bench, broadcast_bytes=0), *columns) == want
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and counted(kept, "doc_id") == collections.Counter((i,) for i, _, _ in ROWS if i not in dirty)
    cut = decontaminate.decontaminate(docs, bench, remove="spans")
    assert cut.count() == len(ROWS) and decontaminate.contamination(cut, bench).filter("contaminated").count() == 0
    assert {r.doc_id: r.text for r in cut.collect()}[5] == "only"
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0


def brute_repeats(rows, k):
    seen, want = {}, collections.Counter()
    for i, t, *_ in sorted(rows, key=lambda r: order(r[0])):
        w = (t or "").encode().split()
        for p in range(len(w) - k + 1):
            key = tuple(w[p : p + k])
            seen[key] = min(seen.get(key, (order(i), p)), (order(i), p))
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        gone = set()
        for p in range(len(w) - k + 1):
            if seen[tuple(w[p : p + k])] < (order(i), p):
                gone |= set(range(p, p + k))
        want[(i, len(w), len(gone), hashlib.sha256(b" ".join(x for n, x in enumerate(w) if n not in gone)).hexdigest())] += 1
    return want


def test_substring_dedup(docs, empty):
    for k in (20, 8):
        assert counted(substring_dedup.remove_repeats(docs, k), "doc_id", "n_words", "n_removed", "kept_sha256") == brute_repeats(ROWS, k)
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_substring_dedup_keeps_edges_of_one_minimizer_apart():
    # 300,000 different windows of one minimizer, each held by two documents: none may hide another
    n = 300_000
    m, edges = np.full(n, 5, np.uint64), kernels.mix(np.arange(n, dtype=np.uint64))
    docs = lambda d: substring_dedup._pack(np.zeros(n, np.int64), 0, np.full(n, d, np.int64), np.arange(n) * 2, np.ones(n, np.int64), m, b=edges)
    out = substring_dedup._resolve(4)(pa.Table.from_batches([docs(1), docs(2)]))
    docs_, starts, counts, src, at = substring_dedup._unpack(out, np.int32)
    assert len(docs_) == n and (counts == 1).all() and (docs_ == 2).all() and (src.view(np.int64) == 1).all() and (starts == at).all()


def test_toxicity(spark, empty):
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for i in range(900):
        w = [f"w{x}" for x in rng.integers(0, 300, 40)]
        bad = i % 4 == 0
        texts.append((i, " ".join(w + ["awful", "Nasty!"] * bad), "x"))
        labels.append((i, int(bad), None))
    docs = spark.createDataFrame([*texts, (None, "awful nasty", "x"), (2000, None, "x"), (2001, "", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([*labels, (None, 1, None), (2000, None, 1)], "doc_id long, toxic int, text string")
    got = toxicity.score(docs, toxicity.fit(docs, labels, bits=16)).collect()
    assert len(got) == 903
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    right = np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held if r.doc_id < 900])
    assert right > 0.97 and all(0 <= r.score <= 1 for r in got)
    model = toxicity.fit(docs, labels.limit(0), bits=12)
    assert toxicity.score(docs, model).count() == 903 and toxicity.score(empty, model).count() == 0


def test_toxicity_on_held_out_rows(spark):
    for sf, least in (("0.1", 0.95), ("0.001", None)):
        at = f"/root/testdata/sf{sf}"
        docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
        got = toxicity.score(docs, toxicity.fit(docs, labels)).filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id").select("score", "toxic").collect()
        assert len({r.score for r in got}) > 5
        if least:
            y, s = np.array([r.toxic for r in got]), np.array([r.score for r in got])
            assert (s[y == 1][:, None] > s[y == 0][None, :]).mean() + (s[y == 1][:, None] == s[y == 0][None, :]).mean() / 2 > least
            assert (s[y == 1] >= 0.3).mean() > 0.85 and (s[y == 0] >= 0.3).mean() < 0.05


def test_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 8))
    v = [(i, [float(x) for x in base[i % 40] + 0.08 * rng.normal(size=8)], i % 3) for i in range(300)]
    v += [(300, None, 1), (301, [], 1), (302, [0.0] * 8, 1), (303, [float("nan")] * 8, 1), (304, [1.0, None] * 4, 1), (305, v[0][1], None), (306, v[0][1], 0), (306, v[0][1], 0), (307, [1.0, 2.0], 0), (308, [2.0, 4.0], 0), (309, [float("inf")] * 8, 0)]
    v += [(310 + i, [x * m for x in v[0][1]], 0) for i, m in enumerate((1e290, 1e-290, 4.0))]  # squares that overflow or vanish
    df = spark.createDataFrame([(*r, "x") for r in v], "vec_id long, embedding array<double>, label int, cell string")
    fine = [r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in v]
    links = collections.defaultdict(set)
    for a in range(len(v)):
        for b in range(len(v)):
            if a != b and fine[a] and fine[b] and v[a][2] == v[b][2] and len(v[a][1]) == len(v[b][1]):
                x, y = (np.array(e) / max(map(abs, e)) for e in (v[a][1], v[b][1]))
                if (x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())) >= 0.98:
                    links[a].add(b)
    want = collections.Counter()
    for a in range(len(v)):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        c = min(v[x][0] for x in seen)
        want[(v[a][0], len(links[a]), c, v[a][0] == c)] += 1
    for settings in ({}, {"cell_rows": 10, "block": 7}, {"cell_rows": 10, "part_bytes": 512}):
        assert counted(vector_dedup.near_vectors(df, **settings), "vec_id", "n_links", "component_id", "kept") == want
    assert sum(len(x) for x in links.values()) > 100
    assert vector_dedup.near_vectors(df.limit(0)).count() == 0


def test_vectors_are_not_replicated(spark, tmp_path):
    """One label, 64 dimensions, where pivots prune nothing: all pairs are compared, and no shuffle or table holds a vector twice."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64)).astype(np.float32)
    x[2000:] = x[:1000] + 0.05 * rng.normal(size=(1000, 64)).astype(np.float32)
    spark.createDataFrame([(i, e.tolist(), 1) for i, e in enumerate(x)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/v")
    at = Path(common.shared_folder(spark))
    size = lambda: sum(p.stat().st_size for p in at.rglob("*.parquet"))
    had = size()
    got = vector_dedup.near_vectors(spark.read.parquet(f"{tmp_path}/v"), cell_rows=100, block=256).collect()
    used = size() - had
    u = x.astype(float) / np.sqrt((x.astype(float) ** 2).sum(1))[:, None]
    links = u @ u.T >= 0.98
    assert {r.vec_id: r.n_links for r in got} == dict(enumerate((links.sum(1) - 1).tolist())) and links.sum() > 4500
    assert x.nbytes < used < 2 * x.nbytes


def test_token_counts(spark, docs, empty, tmp_path):
    counts = {r.doc_id: r for r in token_counts.count_tokens(docs.filter("doc_id < 15")).collect()}
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokens.vocabulary_path())
    for i, t, _ in ROWS:
        if i is not None and i < 15:
            assert counts[i].bpe == len(tk.encode(t or "", add_special_tokens=False).ids) and counts[i].words == len((t or "").encode().split())
    totals = counted(token_counts.corpus_rollup(docs), "source", "lang", "tokenizer", "n_docs", "n_tokens")
    first = {}
    for i, t, la in sorted(ROWS, key=lambda r: order(r[0])):
        first.setdefault(t or "", (f"s{(i or 0) % 3}", la, t or ""))
    want = collections.defaultdict(lambda: [0, 0])
    for s, la, t in first.values():
        for name, n in (("byte_bpe_50k", len(tk.encode(t, add_special_tokens=False).ids)), ("white_space_1", len(t.encode().split()) + 1)):
            want[(s, la, name)][0] += 1
            want[(s, la, name)][1] += n
    assert totals == collections.Counter({(*k, *v): 1 for k, v in want.items()})
    r = token_counts.Rollup(spark, str(tmp_path / "rollup"))
    change = spark.createDataFrame([("s", "en", "v", None, 5), ("s", "en", "v", 5, 7), (None, None, "v", None, 3), (None, None, "v", 3, None)], "source string, lang string, tokenizer string, old_tokens long, new_tokens long")
    assert r.totals().count() == 0 and r.commit("a", change) and not r.commit("a", change)
    assert [tuple(x) for x in r.totals().collect()] == [("s", "en", "v", 1, 7)]
    assert [tuple(x) for x in token_counts.compact(r, str(tmp_path / "small"), "b").totals().collect()] == [("s", "en", "v", 1, 7)]
    small = token_counts.Rollup(spark, str(tmp_path / "small"))
    assert small.batches() == ["a", "b"] and not small.commit("a", change) and small.commit("c", change)  # a was folded in
    assert [tuple(x) for x in small.totals().collect()] == [("s", "en", "v", 2, 14)]
    change.limit(1).selectExpr("source", "lang", "tokenizer", "5L as n_docs", "5L as n_tokens").write.parquet(str(tmp_path / "half" / "batch=a"))
    (tmp_path / "half" / "batch=a" / "_SUCCESS").unlink()  # a job that died before it was done
    half = token_counts.Rollup(spark, str(tmp_path / "half"))
    assert half.totals().count() == 0 and half.commit("a", change) and [tuple(x) for x in half.totals().collect()] == [("s", "en", "v", 1, 7)]
    assert token_counts.corpus_rollup(empty).count() == 0


def test_line_dedup(docs, empty):
    key = lambda x: x.strip(" \t\n\r\x0b\x0c").translate(LOW)
    first = {}
    for i, t, _ in sorted(ROWS, key=lambda r: order(r[0])):
        for x in (t or "").split("\n"):
            first.setdefault(key(x), i)
    want = collections.Counter()
    for i, t, _ in ROWS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == i]
        want[(i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    assert counted(line_dedup.drop_lines(docs, keep=("bucket", "key")), "doc_id", "n_lines", "n_dropped", "kept_sha256") == want
    index = line_dedup.build_index(docs)
    assert counted(line_dedup.drop_lines(docs, index=index), "doc_id", "n_lines", "n_dropped", "kept_sha256") == want
    assert line_dedup.drop_lines(empty).count() == 0
    keys = kernels.mix(np.arange(5000, dtype=np.uint64))
    assert sorted(line_dedup.probe_levels(line_dedup.build_levels(keys), keys)) == list(range(5000))


def test_pseudo_likelihood(spark, docs, empty):
    rng = np.random.default_rng(2)
    chain = lambda: " ".join(x for _ in range(60) for x in (("red", "green", "blue") if rng.random() < 0.95 else ("blue", "red", "green")))
    rows = [(i, chain(), "x") for i in range(60)] + [(100, " ".join(rng.permutation(["red", "green", "blue"] * 60)), "x"), (101, None, "x"), (102, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, cells string")
    got = {r.doc_id: r for r in pseudo_likelihood.score(df, pseudo_likelihood.fit(df)).collect()}
    assert len(got) == 63 and got[101].n_words == 0 and got[101].log_likelihood == 0 and got[102].mean_log_likelihood is None
    assert min(got[i].mean_log_likelihood for i in range(60)) > got[100].mean_log_likelihood + 0.5
    assert pseudo_likelihood.score(docs, pseudo_likelihood.fit(empty)).count() == len(ROWS)
    assert pseudo_likelihood.score(empty, pseudo_likelihood.fit(docs)).count() == 0


def test_pseudo_likelihood_predicts_words_of_a_large_vocabulary(spark):
    rng = np.random.default_rng(4)
    # 3,000 content words in fixed pairs between frequent words; a text with other partners has the same words and classes in order
    pair = lambda i: f"the noun{i} of verb{i} and"
    texts = [" ".join(pair(i) for i in rng.permutation(1500)[:200]) for _ in range(60)]
    i = rng.permutation(1500)[:200]
    swapped = " ".join(f"the noun{a} verb{b} of and" for a, b in zip(i, np.roll(i, 1), strict=True))
    texts = [t.replace(" of verb", " verb").replace(" and", " of and") for t in texts]
    straight = " ".join(f"the noun{a} verb{a} of and" for a in i)
    df = spark.createDataFrame([*enumerate(texts), (100, straight), (101, swapped)], "doc_id long, text string")
    model = pseudo_likelihood.fit(df)
    got = {r.doc_id: r.mean_log_likelihood for r in pseudo_likelihood.score(df, model).collect()}
    assert got[100] > got[101] + 1
    assert len(model["heads"]["words"]) == 48
    wide = pseudo_likelihood.fit(spark.createDataFrame([(1, " ".join(f"w{j}" for j in range(60000)))], "doc_id long, text string"))
    assert wide["heads"]["kinds"].sum() == 60000 and len(wide["heads"]["words"]) == 60


def test_pseudo_likelihood_equals_a_brute_force_one(spark, docs):
    texts = {i: (t or "").translate(LOW).encode().split() for i, t, _ in ROWS if i is not None and i not in (10, 15)}
    texts |= {100 + i: f"the cat{i % 3} sat on the mat{i % 5} and slept".encode().split() for i in range(30)}
    df = spark.createDataFrame([(i, b" ".join(t).decode()) for i, t in texts.items()], "doc_id long, text string")
    model = pseudo_likelihood.fit(df)
    heads, p = model["heads"], {k: x.astype(float) for k, x in model["network"].items()}
    vocabulary = collections.Counter(w for t in texts.values() for w in t)
    hashed = {w: int(kernels.words_of(pa.array([w.decode()]))[0][0]) for w in vocabulary}
    frequent = {int(h): i for i, h in enumerate(heads["word"])}
    kind = {w: frequent.get(h, len(frequent) + (h >> 7) % heads["shared"]) for w, h in hashed.items()} | {None: len(heads["words"])}
    tokens_of, kinds_of = collections.Counter(), collections.Counter(kind[w] for w in vocabulary)
    for w, n in vocabulary.items():
        tokens_of[kind[w]] += n
    assert [tokens_of[c] for c in range(len(heads["words"]))] == heads["words"].tolist() and [kinds_of[c] for c in range(len(heads["kinds"]))] == heads["kinds"].tolist()
    pairs = collections.Counter(x for t in texts.values() if t for x in zip([None, *t], [*t, None], strict=True))
    single = vocabulary | collections.Counter({None: sum(bool(t) for t in texts.values())})
    rows, size = len(heads["words"]) + 1, p["e"].shape[1]
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()

    def classes(around):
        a = p["b"].copy()
        for k, w in enumerate(around):
            a += p["e"][k * rows + kind[w]] @ p["w"][k * size : (k + 1) * size]
        a = np.tanh(a)
        top = soft(a @ p["u"] + p["d"])
        return np.concatenate([top[g] * soft(a @ p["v"][g] + p["c"][g]) for g in range(len(top))])

    def chance(of, w, left, right, own):
        q = of[kind[w]] * (vocabulary[w] + 1) / (tokens_of[kind[w]] + kinds_of[kind[w]] + 1)
        side = lambda pair, beside: (max(pairs[pair] - own, 0) + 4 * q) / (max(single[beside] - own, 0) + 4)
        return (side((left, w), left) + side((w, right), right)) / 2

    for own in (True, False):
        got = {r.doc_id: r for r in pseudo_likelihood.score(df, model, own=own).collect()}
        for i, t in texts.items():
            at, want = [None, None, *t, None, None], 0.0
            for j in range(2, len(t) + 2):
                of = classes([at[j + d] for d in (-2, -1, 1, 2)])
                want += np.log(chance(of, at[j], at[j - 1], at[j + 1], own))
            assert got[i].n_words == len(t) and abs(got[i].log_likelihood - want) <= 1e-4 * max(1, abs(want))
    # a place's words share at most 1, and nearly all of it lies on known words and borders
    of = classes([b"the", b"cat0", b"on", b"the"])
    total = sum(chance(of, w, b"cat0", b"on", False) for w in vocabulary)
    assert abs(of.sum() - 1) < 1e-6 and 0.9 < total <= 1 + 1e-9


def test_sharding(spark, docs, empty):
    got = sharding.shard(docs, 4).collect()
    want = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in ROWS)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want and {r.law for r in got} == {"bytes"}
    of = {}
    for r in got:
        assert of.setdefault(r.text_crc32, r.shard) == r.shard  # equal texts stay together
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(empty, 4).count() == 0
    rng = np.random.default_rng(3)
    for n, parts in ((500, 7), (3, 5), (2000, 40)):
        sizes, keys = rng.integers(1, 100, n) * rng.choice([1, 1, 1, 30], n), np.sort(rng.integers(-(2**63), 2**63 - 1, n))
        groups = spark.createDataFrame([(int(k), int(s)) for k, s in zip(keys, sizes, strict=True)], "key long, size long")
        capacity, cuts = sharding.cut_points(groups, parts)
        low, high = max(int(sizes.max()), -(-int(sizes.sum()) // parts)), int(sizes.sum())

        def fits(c):
            used, held = 1, 0
            for s in sizes.tolist():
                used, held = (used, held + s) if held + s <= c else (used + 1, s)
            return used <= parts

        assert capacity == next(c for c in range(low, high + 1) if fits(c))
        shard = np.searchsorted(np.array(cuts, np.int64), keys, "right") if cuts else np.zeros(n, int)
        assert max(np.bincount(shard, weights=sizes)) <= capacity and len(cuts) < parts


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokens.vocabulary_path())
    got = packing.pack(docs, with_ids=True, group_items=5).collect()
    want = collections.Counter()
    for i, t, _ in ROWS:
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 2]
        cut = [0, *range(len(ids) - 1024 * ((len(ids) - 1) // 1024), len(ids), 1024), len(ids)]
        for p, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            want[(i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), tuple(ids[a:b]))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(empty).count() == 0
    rng = np.random.default_rng(4)
    sizes = np.sort(rng.integers(1, 1024, 5000))[::-1]
    assert packing.sum_of_squares(sizes, 1024)[0].max() + 1 <= 1.012 * sizes.sum() / 1024


def test_pieces_give_the_ids_of_the_text():
    from tokenizers import Tokenizer

    tk, ids = Tokenizer.from_file(tokens.vocabulary_path()), tokens.Ids(tokens.vocabulary_path())
    texts = [r[1] for r in ROWS] + ["a  b\n\nc \n d", " lead", "trail ", "x  y  z", "it's 12 we'll\x1c a\x1f b", "say <|endoftext|> twice<|endoftext|>", "　 a 　b", "é f", "\r\n a\r b"]
    flat, first = ids.of(pa.array(texts))
    for t, a, b in zip(texts, first[:-1], first[1:], strict=True):
        assert flat[a:b].tolist() == tk.encode(t or "", add_special_tokens=False).ids, t


def brute_near(rows, least=0.8):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().split()
        sets.append({tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    n = len(rows)
    links = {a: {b for b in range(n) if a != b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]) - 1e-9} for a in range(n)}
    want = collections.Counter()
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        want[(rows[a][0], min((rows[x][0] for x in seen if rows[x][0] is not None), default=None), len(links[a]), len(sets[a]))] += 1
    return want


def test_ngram_join(spark, docs, empty):
    rng = np.random.default_rng(5)
    rows = [r[:2] for r in ROWS]
    for g in range(12):
        base = [f"g{g}t{x}" for x in rng.integers(0, 5000, 120)]
        for c in range(6):
            w = list(base)
            w[int(rng.integers(0, 120))] = f"edit{g}{c}"
            rows.append((1000 + 10 * g + c, " ".join(w)))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, cluster string, side int")
    for settings in ({}, {"block": 3, "branch_block": 3}):
        assert counted(ngram_join.near_texts(df, **settings), "doc_id", "class_id", "n_links", "n_shingles") == brute_near(rows)
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    assert counted(kept, "doc_id")[(15,)] == 1 and counted(kept, "doc_id")[(6,)] == 0 and counted(kept, "doc_id")[(2,)] == 1
    assert ngram_join.near_texts(empty).count() == 0 and ngram_join.one_of_each(empty).count() == 0


def test_ngram_join_keeps_one_row_of_each_class_without_ids(spark):
    words = lambda name: [f"{name}{i}" for i in range(80)]
    near = lambda name, k: " ".join(["x" * k, *words(name)[1:]])
    rows = [
        (5, " ".join(words("a"))), (None, " ".join(words("a"))), (None, near("a", 1)),  # null copies of document 5
        *((None, near("b", k)) for k in range(1, 5)), (None, near("b", 1)),  # null copies of each other
        (7, near("c", 1)), (7, near("c", 2)), (7, near("c", 2)), (8, near("c", 3)),  # one id, several texts
        (None, "alone without a key"), (None, None), (None, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.class_id) for r in ngram_join.near_texts(df).filter("kept and n_shingles > 0").collect()]
    assert collections.Counter(kept) == collections.Counter([(5, 5), (None, None), (7, 7), (None, None)])
    got = [(r.doc_id, r.text) for r in ngram_join.one_of_each(df).collect()]
    group = collections.Counter("none" if not t else "alone" if t.startswith("alone") else t.split()[1][0] for _, t in got)
    assert group == {"a": 1, "b": 1, "c": 1, "alone": 1, "none": 2} and (5, " ".join(words("a"))) in got and set(got) <= set(rows)


def test_ngram_join_recall_on_drifting_versions(spark):
    # chains of versions: neighbours lie just above the threshold, later ones further and further below, so leaders can split pairs
    rng = np.random.default_rng(6)
    rows = []
    for g in range(40):
        w = [f"g{g}t{x}" for x in range(160)]
        for c in range(40):
            for e in range(int(rng.integers(2, 4))):
                w[int(rng.integers(0, 160))] = f"g{g}c{c}e{e}"
            rows.append((len(rows), " ".join(w)))
    sets = [{tuple(t.split()[p : p + 5]) for p in range(156)} for _, t in rows]
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9
    pairs = [(a, b) for a in range(len(rows)) for b in range(a + 1, min(len(rows), (a // 40 + 1) * 40)) if near(a, b)]
    want = collections.Counter(x for p in pairs for x in p)
    got = {r.doc_id: r for r in ngram_join.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].n_links <= want[i] for i in got)  # no link that is none
    recall, joined = sum(r.n_links for r in got.values()) / sum(want.values()), np.mean([got[a].class_id == got[b].class_id for a, b in pairs])
    print(f"{len(pairs)} pairs, recall {recall:.4f}, in one class {joined:.4f}")
    assert recall > 0.97 and joined > 0.97


def test_may_meet_keeps_every_row_that_meets(spark):
    rows = spark.range(2000).selectExpr("IF(id = 7, NULL, id) AS a")
    keys = spark.range(0, 2000, 9).selectExpr("IF(id = 9, NULL, id) AS b")
    wanted = {r.b for r in keys.collect()}
    for words in (1, 1 << 20):
        out = [r.a for r in blocks.may_meet(rows, "a", keys, "b", words).collect()]
        assert len(out) == len(set(out)) and wanted - {9} <= set(out)
    assert len(out) < 2 * len(wanted)
    assert blocks.may_meet(rows, "a", keys.limit(0), "b").count() == 0
