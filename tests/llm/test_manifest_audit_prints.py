"""Merkle manifest, filter audit and fingerprints against brute-force versions, with the edge rows that their docstrings define."""

import collections
import hashlib
import itertools
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelkiln.llm import filter_audit, fuzzy_hash, kernels, merkle, queries

from ..conftest import DATA

LONG = "\n".join(f"line {i} holds word{i % 977} and W{i // 500}" for i in range(6000))
ROWS = [
    (i, text, lang, source, n)
    for i, (text, lang, source, n) in enumerate(
        [("one\ntwo\nthree", "en", "a", 13), (None, None, "a", None), ("", "en", "a", 0), (LONG, "en", "a", len(LONG)), ("A B # C", "fr", None, 7), ("x\ny", "fr", None, 3), ("ñandú 東京\n", "de", "b", 9), ("only", "de", "c", 4)]
        + [(f"text {i}\nof source a " + " ".join(f"w{i * k % 91}" for k in range(i * 3)), "en", "a", i) for i in range(22)]
        + [("the same words again", "fr", "b", 20)] * 5
    )
] + [(None, "no key\n", "en", "a", 7), (None, None, None, None, None), (3, LONG, "en", "a", len(LONG)), (40, "twin", "en", "b", 4), (40, "twin", "en", "b", 4), (40, "twin", "fr", "b", 4)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos long, n int, digest string, part string, path int, good int, failed int, key int, salt int, range int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "t", 1, 2, "d", "p", 3, 4, 5, 6, 7, 8) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(df):
    return collections.Counter(tuple(r) for r in df.collect())


# manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(i, text, lang, source, n):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def climb(nodes):
    """The root, and for each node its siblings (before, after) level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, k in zip(paths, at, strict=True):
            run = nodes[k // 3 * 3 : k // 3 * 3 + 3]
            p.append((run[: k % 3], run[k % 3 + 1 :]))
        nodes, at = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)], [k // 3 for k in at]
    return nodes[0], paths


def brute_manifest(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    of = {s: sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for s in sources}
    trees = {s: climb([leaf(*r) for r in of[s]]) for s in sources}
    root, tops = climb([trees[s][0] for s in sources])
    for s, top in zip(sources, tops, strict=True):
        for r, path in zip(of[s], trees[s][1], strict=True):
            whole = path + top
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            at = leaf(r[0], r[1].replace("\n", ""), *r[2:]) if tampered else leaf(*r)
            for before, after in whole:
                at = h(*before, at, *after)
            yield r[0], leaf(*r), trees[s][0], root, h(*(x for b, a in whole for x in (*b, *a))), at, at == root


def tampered():
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest(docs, levels):
    got = counted(merkle.audit(docs, tampered(), levels=levels))
    assert got == collections.Counter(brute_manifest(ROWS))
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_any_size(spark):
    for n in (1, 2, 3, 4, 9, 10, 28, 82):
        rows = [(i, f"t{i}\n", "en", "s", i) for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        assert counted(merkle.audit(df, tampered(), levels=2)) == collections.Counter(brute_manifest(rows)), n


def test_manifest_of_nothing(empty):
    assert merkle.audit(empty, tampered()).collect() == []


def test_a_hot_source_spreads(spark):
    """No window and no join of the plan is dealt by source alone."""
    df = spark.createDataFrame([(i, f"t{i}", "en", "s", i) for i in range(50)], "doc_id long, text string, lang string, source string, n_chars long")
    plan = merkle.audit(df, levels=2)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\((.*?), \d+\)", plan)
    assert dealt and all("," in x for x in dealt), dealt


# filter audit

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute_audit(rows, labels):
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    judged = []
    for i, text, lang, *_ in rows:
        t = text or ""
        w = SPACE.findall(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and first[t] < i}
        judged.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    for part in {p for p, *_ in judged}:
        own, out = [r for r in judged if r[0] == part], []
        for order in itertools.permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                earlier = [r for r in own if f in r[1] and set(order[:k]) & r[1]]
                out.append((part, "".join(order), k + 1, len(left), len(gone), len(earlier), sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        share = collections.Counter()
        for r in out:
            share[r[1][r[2] - 1]] += r[4]
        yield from ((*r, share[r[1][r[2] - 1]]) for r in out)


def test_audit(spark, docs, empty):
    labels = [(0, 1, 0), (0, 0, 1), (3, 1, 1), (5, None, 1), (9, 1, None), (40, 1, 0), (None, 1, 1), (99, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = counted(filter_audit.audit(docs, table))
    assert got == collections.Counter(brute_audit(ROWS, labels))
    assert filter_audit.audit(empty, table).collect() == []
    none = counted(filter_audit.audit(docs, table.limit(0)))
    assert none == collections.Counter(brute_audit(ROWS, []))


def test_shapley_weights():
    """The least squares solution is the mean over all orders, in rationals."""
    for p in (2, 3, 5):
        want = [[Fraction(0)] * (1 << p) for _ in range(p)]
        orders = list(itertools.permutations(range(p)))
        for order in orders:
            s = 0
            for i in order:
                want[i][s] -= Fraction(1, len(orders))
                s |= 1 << i
                want[i][s] += Fraction(1, len(orders))
        assert filter_audit.shapley_weights(p) == want


# fingerprints


def brute_print(text):
    """From the definition: hash of the last eight bytes at each byte, chunk ends by its low bits, two symbols a chunk."""
    data, m32, m64 = (text or "").encode(), (1 << 32) - 1, (1 << 64) - 1

    def ends(bits):
        out = []
        for at in range(len(data)):
            x = sum(int(fuzzy_hash.VALUES[data[at - k]]) * pow(0x9E3779B1, k, 1 << 32) for k in range(min(8, at + 1))) & m32
            x = (x ^ x >> 15) * 0x85EBCA6B & m32
            x ^= x >> 13
            if x & ((1 << bits) - 1) == (1 << bits) - 1:
                out.append(at)
        return out

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & m64
        x = (x ^ x >> 27) * 0x94D049BB133111EB & m64
        return x ^ x >> 31

    def symbols(bits):
        cuts = [0, *(e + 1 for e in ends(bits) if e + 1 < len(data))][:64] if data else []
        text = ""
        for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True) if cuts else ():
            x = sum(int(kernels.BYTE_VALUES[c]) * pow(kernels.R_BYTE, k, 1 << 64) for k, c in enumerate(data[a:b])) & m64
            x = mix(x ^ mix(b - a))
            text += chr(fuzzy_hash.SYMBOLS[x >> 20 & 63]) + chr(fuzzy_hash.SYMBOLS[x >> 40 & 63])
        return text

    level = 0
    while len(data) > 48 << level:
        level += 1
    while level and len(ends(level)) < 16:
        level -= 1
    return f"{1 << level}:{symbols(level)}:{symbols(level + 1)}"


def brute_likeness(a, b):
    def parts(x):
        size, one, two = x.split(":")
        return {int(size): one, 2 * int(size): two}

    def distance(x, y):
        line = list(range(len(y) + 1))
        for i, p in enumerate(x):
            new = [i + 1]
            for j, q in enumerate(y):
                new.append(min(line[j] + (p != q), line[j + 1] + 1, new[j] + 1))
            line = new
        return line[-1]

    best, (x, y) = 0.0, (parts(a), parts(b))
    for size in x.keys() & y.keys():
        s, t = ([v[i : i + 2] for i in range(0, len(v), 2)] for v in (x[size], y[size]))
        best = max(best, 1 - distance(s, t) / max(len(s), len(t)) if s and t else float(len(s) == len(t)))
    return best


RNG = np.random.default_rng(3)
WORDS = ["".join(map(chr, RNG.integers(97, 123, n))) for n in RNG.integers(2, 9, 400)]
TEXTS = [" ".join(RNG.choice(WORDS, n)) for n in (1, 3, 8, 12, 20, 40, 70, 150, 300)] + ["", None, "a" * 3000, "ha " * 700, "ñ東 " * 90, "x", "yz"]


def test_fingerprints_by_definition():
    column = pa.array([*TEXTS, *TEXTS[:3]])
    got = fuzzy_hash.Prints(column)
    assert got.text() == [brute_print(t) for t in column.to_pylist()]
    i, j = (np.array(x) for x in zip(*itertools.product(range(len(TEXTS)), repeat=2), strict=True))
    prints = got.text()
    assert np.allclose(fuzzy_hash.likeness(got, i, got, j), [brute_likeness(prints[a], prints[b]) for a, b in zip(i, j, strict=True)])


def test_fingerprints_do_not_depend_on_neighbours(docs, monkeypatch):
    want = collections.Counter((r[0], brute_print(r[1]) if r[1] != LONG else None) for r in ROWS)
    got = [tuple(r) for r in fuzzy_hash.fingerprints(docs).collect()]
    long = fuzzy_hash.Prints(pa.array([LONG])).text()[0]
    assert collections.Counter((i, None if p == long else p) for i, p in got) == want
    monkeypatch.setattr(kernels, "SEGMENT", 1000)
    assert fuzzy_hash.Prints(pa.array(["before", LONG, "after"])).text()[1] == long


def brute_following(rows):
    """The multiset of results; texts of equal doc_id stand in any order that the operator took, so such rows compare by doc_id alone."""
    rows = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for (i, a), (_, b) in zip(rows, rows[1:] + rows[:1], strict=True):
        k = len(a) // 4
        edited = a[: len(a) - k] + b[:k]
        yield i, len(a), hashlib.sha256(edited.encode()).hexdigest(), a, edited, b


@pytest.mark.parametrize("chunk", [100, 2 << 20])
def test_following_texts(spark, monkeypatch, chunk):
    texts = [*TEXTS, "the same words here", "the same words here", None, None]
    rows = [(i * 7, t) for i, t in enumerate(texts)]
    monkeypatch.setattr(fuzzy_hash, "CHUNK_BYTES", chunk)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, key int").repartition(4)
    got = {r.doc_id: r for r in fuzzy_hash.following_texts(df).collect()}
    assert len(got) == len(rows)
    for i, n, sha, a, edited, b in brute_following(rows):
        r = got[i]
        pa_, pe, pb = brute_print(a), brute_print(edited), brute_print(b)
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (n, sha, pa_, pe)
        assert r.near_edited == pytest.approx(brute_likeness(pa_, pe)) and r.near_next == pytest.approx(brute_likeness(pa_, pb))


def test_following_texts_with_ties(spark, docs, empty):
    out = fuzzy_hash.following_texts(docs).collect()
    assert collections.Counter((r.doc_id, r.n_chars) for r in out) == collections.Counter((r[0], len(r[1] or "")) for r in ROWS)
    assert counted(fuzzy_hash.following_texts(docs)) == counted(fuzzy_hash.following_texts(docs.repartition(7, "text")))
    assert fuzzy_hash.following_texts(empty).collect() == []
    alone = fuzzy_hash.following_texts(spark.createDataFrame([(1, "a text of its own")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.near_edited < 1, r.near_next) for r in alone] == [(1, True, 1.0)]


def test_likeness_tells_edits_from_other_texts(spark):
    """Over the documents: a text with its last quarter replaced stays alike, the next document is not."""
    out = queries.op13_document_fingerprints(spark, DATA).filter("n_chars >= 200").collect()
    near, other = sorted(r.near_edited for r in out), sorted(r.near_next for r in out)
    assert near[len(near) // 20] > 0.5 and other[len(other) * 9 // 10] < 0.3
