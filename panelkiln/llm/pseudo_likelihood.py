"""Masked pseudo-likelihood: a bidirectional window network predicts every word from both sides.

Words are 64-bit hashes, counted exactly over the whole corpus; the number of classes grows with the cube root of the
counted vocabulary (the most frequent words are classes of their own, the others share classes by hash). A word is
predicted step by step: the network reads the classes of two words on each side through embeddings and a tanh layer
and predicts a group of classes and the class within it (a softmax of two levels, whose cost grows with the root of the
classes), in which the word has its share. On each side, counts of the word beside its very
neighbour are smoothed by that prediction, and the mean of both sides is the word's probability. The border of a text
counts as a neighbour.

The network is trained by tasks on all words of the corpus: in each round every task takes steps over its part of the
texts from the same parameters, and the results are averaged by words. A small corpus is read several times, a large
one once. The neighbour counts stay a table, by hashes of 32 bits within parts whose number follows the input; texts ask
it for their own keys, chunk by chunk, so no task or driver holds the table. Chunks are dealt by a hash of doc_id and
text, so that copies of one text spread.

Defined results: a null or blank text has 0 words, log-likelihood 0 and no mean. Rows with a null or repeated doc_id are
scored like others. All words of a very long text count. Other columns play no part. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import buckets, partitions, settle

#: The border word, and salts of the kinds of keys: word, word and the next one.
BORDER, WORD, PAIR = (np.uint64(x) for x in (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D))
#: Words that training reads at least, by up to PASSES passes, and the rounds of one pass.
LEAST_WORDS, PASSES, ROUNDS = 2_000_000, 6, 4
#: Text bytes of a chunk: words, keys and counts take some 30 times as much.
CHUNK_BYTES = 4 << 20


def _both(a: np.ndarray, b: np.ndarray, salt: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        return K.mix((a * np.uint64(K.R_WORD) ^ K.mix(b + salt)) + salt)


def _planes(x: np.ndarray) -> bytes:
    """Numbers of 32 bits as four planes of bytes, which compress well where most are small."""
    return x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _flat_planes(blob) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob.as_py(), np.uint8).reshape(4, -1).T).view(np.uint32).reshape(-1)


def _rising(x: np.ndarray) -> bytes:
    """Sorted numbers of 32 bits as planes of their differences."""
    return _planes(np.diff(x, prepend=np.uint32(0)))


def _unpacked(column, rising: bool) -> list[np.ndarray]:
    out = [_flat_planes(b) for b in column]
    return [np.cumsum(x, dtype=np.uint32) for x in out] if rising else out


def _packed(keys: np.ndarray, parts: int, counted: bool = True) -> dict:
    """Distinct keys by part (32 bits of each) and how often they occur."""
    keys = np.sort(((keys % np.uint64(parts)) << np.uint64(32)) | (keys >> np.uint64(32)))
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    n, unique = np.diff(np.append(first, len(keys))).astype(np.int32), keys[first]
    cut = np.searchsorted(unique >> np.uint64(32), np.arange(parts + 1))
    small, some = unique.astype(np.uint32), np.flatnonzero(np.diff(cut))
    out = {"part": pa.array(some.astype(np.int32)), "keys": pa.array([_rising(small[cut[p] : cut[p + 1]]) for p in some], pa.binary())}
    return out | ({"n": pa.array([_planes(n[cut[p] : cut[p + 1]]) for p in some], pa.binary())} if counted else {})


def _ranked(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of keys (a part and 32 bits), and in it each one's number among the distinct ones. Where key and place fit
    one number of 64 bits that is sorted, much faster than by argsort."""
    bits = np.uint64(max(1, len(keys) - 1).bit_length())
    if 32 + (parts - 1).bit_length() + int(bits) <= 64:
        both = np.sort((keys << bits) | np.arange(len(keys), dtype=np.uint64))
        by, keys = (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), both >> bits
    else:
        by = np.argsort(keys)
        keys = keys[by]
    return by, np.cumsum(np.append(False, keys[1:] != keys[:-1]))


def _summed(t: pa.Table) -> pa.Table:
    """Adds up counts of one part's words."""
    keys, total = _sums(K.ints(t.column("keys"), np.uint64), K.ints(t.column("n"), np.int32))
    return pa.table({"part": t.column("part")[:1].cast(pa.int32()), "keys": pa.array([keys.tobytes()], pa.binary()), "n": pa.array([total.tobytes()], pa.binary())})


def _summed_pairs(t: pa.Table) -> pa.Table:
    """Adds up packed counts of one part."""
    keys, total = _sums(np.concatenate(_unpacked(t.column("keys"), True)), np.concatenate(_unpacked(t.column("n"), False)))
    return pa.table({"part": t.column("part")[:1].cast(pa.int32()), "keys": pa.array([_rising(keys)], pa.binary()), "n": pa.array([total.tobytes()], pa.binary())})


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order, cut = K.grouped(keys)
    return keys[order[cut[:-1]]], np.add.reduceat(n[order].astype(np.int64), cut[:-1]) if len(keys) else np.zeros(0, np.int64)


def _class_of(word: np.ndarray, heads: dict) -> np.ndarray:
    """Classes of words: a frequent word's own, or one of the shared."""
    own = len(heads["word"])
    out = own + ((word >> np.uint64(7)) % np.uint64(heads["shared"])).astype(np.int64)
    if own:
        at = np.minimum(np.searchsorted(heads["word"], word), own - 1)
        out = np.where(heads["word"][at] == word, at, out)
    return out


def _positions(column, heads: dict | None):
    """Words and (with heads) classes with two borders on either side of each row, the words' places among them, and each row's first word."""
    word, first = K.words_of(column, lower=True)
    n = np.diff(first)
    at = np.arange(len(word)) + 4 * np.repeat(np.arange(len(n)), n) + 2
    words = np.full(len(word) + 4 * len(n), BORDER, np.uint64)
    words[at], classes = word, None
    if heads is not None:
        classes = np.full(len(words), len(heads["word"]) + heads["shared"], np.int64)
        classes[at] = _class_of(word, heads)
    return words, classes, at, first


def _keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each word (borders too), and of each word and the next one."""
    return _both(words, np.zeros_like(words), WORD), _both(words[:-1], words[1:], PAIR)


def _vocabulary(text: DataFrame, parts: int) -> dict:
    """The frequent words, and each class's words and distinct words; the whole vocabulary is counted by word, part by part."""

    def words(batches):
        for t in K.chunks(batches):
            h, _ = K.words_of(t.column("text"), lower=True)
            if len(h):
                h = np.sort(h)
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                unique, n = h[first], np.diff(np.append(first, len(h))).astype(np.int32)
                order, cut = K.grouped((unique % np.uint64(parts)).astype(np.int32))
                unique, n, some = unique[order], n[order], unique[order[cut[:-1]]] % np.uint64(parts)
                held = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary())  # noqa: E731, B023
                yield pa.record_batch({"part": pa.array(some.astype(np.int32)), "keys": held(unique), "n": held(n)})

    kind = "part int, keys binary, n binary"
    table = settle(text.mapInArrow(words, kind).groupBy("part").applyInArrow(_summed, kind), "vocabulary")
    size = table.agg(F.coalesce(F.sum(F.octet_length("keys")), F.lit(0))).first()[0] // 8
    own = max(32, int(np.ceil(size ** (1 / 3))))

    def top(batches):
        for t in batches:
            for keys, n in zip(t.column("keys"), t.column("n"), strict=True):
                keys, n = np.frombuffer(keys.as_py(), np.uint64), np.frombuffer(n.as_py(), np.int64)
                best = np.lexsort((keys, -n))[:own]
                yield pa.record_batch({"word": pa.array(keys[best].view(np.int64)), "n": pa.array(n[best])})

    best = table.mapInArrow(top, "word long, n long").orderBy(F.desc("n"), "word").limit(own).collect()
    heads = {"word": np.sort(np.array([r.word for r in best], np.int64).view(np.uint64)), "shared": -(-own // 2)}
    classes = len(heads["word"]) + heads["shared"]

    def by_class(batches):
        sums = np.zeros((2, classes))
        for t in batches:
            for keys, n in zip(t.column("keys"), t.column("n"), strict=True):
                c, n = _class_of(np.frombuffer(keys.as_py(), np.uint64), heads), np.frombuffer(n.as_py(), np.int64)
                sums += np.stack([np.bincount(c, weights=n, minlength=classes), np.bincount(c, minlength=classes)])
        yield pa.record_batch({"class": pa.array(np.arange(classes)), "words": pa.array(sums[0]), "kinds": pa.array(sums[1])})

    got = table.mapInArrow(by_class, "class long, words double, kinds double").groupBy("class").agg(F.sum("words"), F.sum("kinds")).collect()
    words, kinds = np.zeros(classes), np.zeros(classes)
    for c, n, k in got:
        words[c], kinds[c] = n, k
    return heads | {"words": words, "kinds": kinds}


def _inputs(classes: np.ndarray, at: np.ndarray, border: int) -> np.ndarray:
    """The four inputs of each word as rows of one embedding table."""
    return np.stack([classes[at + d] + k * (border + 1) for k, d in enumerate((-2, -1, 1, 2))], 1)


def _tables(p: dict) -> np.ndarray:
    """What each class in each of the four places adds to the hidden layer."""
    rows, size = len(p["e"]) // 4, p["e"].shape[1]
    return np.concatenate([p["e"][k * rows : (k + 1) * rows] @ p["w"][k * size : (k + 1) * size] for k in range(4)])


def _hidden(p: dict, tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    a = tables[x[:, 0]]
    for k in range(1, 4):
        a += tables[x[:, k]]
    a += p["b"]
    return np.tanh(a, out=a)


def _softmax(s: np.ndarray) -> np.ndarray:
    # down columns and by a product: rows are too short to be reduced one by one
    s -= s.T.copy().max(0)[:, None]
    np.exp(s, out=s)
    s /= (s @ np.ones(s.shape[1], s.dtype))[:, None]
    return s


def _by_group(middle: np.ndarray, wide: int):
    """An order of words by their class's group, and (group, begin, end) of each group in it."""
    g = (middle // wide).astype(np.int16)
    order = np.argsort(g, kind="stable")
    cut = np.searchsorted(g[order], np.arange(int(g.max()) + 2)) if len(g) else np.zeros(1, int)
    return order, [(k, i, j) for k, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if i < j]


def _chances(p: dict, tables: np.ndarray, x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """The network's probability of each word's class."""
    wide = p["v"].shape[2]
    order, parts = _by_group(middle, wide)
    a, m = _hidden(p, tables, x[order]), middle[order]
    top = _softmax(a @ p["u"] + p["d"])
    out = np.empty(len(x))
    for g, i, j in parts:
        rows = np.arange(j - i)
        out[order[i:j]] = top[i:j, g].astype(np.float64) * _softmax(a[i:j] @ p["v"][g] + p["c"][g])[rows, m[i:j] - g * wide]
    return out


def _learn(p: dict, x: np.ndarray, middle: np.ndarray, state: dict, batch: int, rate: float, r) -> None:
    """Adam steps over all given words, once each."""
    mixed = r.permutation(len(x))
    rows, size, wide = len(p["e"]) // 4, p["e"].shape[1], p["v"].shape[2]
    for low in range(0, len(x), batch):
        i = mixed[low : low + batch]
        order, parts = _by_group(middle[i], wide)
        i = i[order]
        xi, mi, n = x[i], middle[i], len(i)
        tables = _tables(p)
        a = _hidden(p, tables, xi)
        # derivatives in the scores of both levels
        top = _softmax(a @ p["u"] + p["d"])
        top[np.arange(n), mi // wide] -= 1
        top /= n
        da = top @ p["u"].T
        dv, dc = np.zeros_like(p["v"]), np.zeros_like(p["c"])
        for g, s, e in parts:
            inner = _softmax(a[s:e] @ p["v"][g] + p["c"][g])
            inner[np.arange(e - s), mi[s:e] - g * wide] -= 1
            inner /= n
            da[s:e] += inner @ p["v"][g].T
            dv[g], dc[g] = a[s:e].T @ inner, inner.sum(0)
        da *= 1 - a * a
        flat = xi.reshape(-1)
        by = np.argsort(flat.astype(np.int16) if len(tables) < 32768 else flat, kind="stable")
        held = flat[by]
        cut = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
        dt = np.zeros_like(tables)
        dt[held[cut]] = np.add.reduceat(da[by // 4], cut)
        de = np.concatenate([dt[k * rows : (k + 1) * rows] @ p["w"][k * size : (k + 1) * size].T for k in range(4)])
        dw = np.concatenate([p["e"][k * rows : (k + 1) * rows].T @ dt[k * rows : (k + 1) * rows] for k in range(4)])
        state["step"] += 1
        first, second = np.float32(1 - 0.9 ** state["step"]), np.float32(1 - 0.999 ** state["step"])
        for k, g in (("e", de), ("w", dw), ("b", da.sum(0)), ("u", a.T @ top), ("d", top.sum(0)), ("v", dv), ("c", dc)):
            m1, m2 = state[k]
            m1 += np.float32(0.1) * (g - m1)
            m2 += np.float32(0.001) * (g * g - m2)
            p[k] -= np.float32(rate) / first * m1 / (np.sqrt(m2 / second) + np.float32(1e-8))


def _start(heads: dict, hidden: int, size: int, seed: int) -> dict:
    """Parameters before training: random layers, and scores that give each class its share."""
    border, r = len(heads["words"]), np.random.default_rng(seed)
    wide = int(np.ceil(np.sqrt(border)))
    groups = -(-border // wide)
    share = np.full(groups * wide, -30.0)  # a place without a class
    share[:border] = np.log(heads["words"] + 1) - np.log(heads["words"].sum() + border)
    share = share.reshape(groups, wide)
    p = {"e": r.normal(0, 0.3, (4 * (border + 1), size)), "w": r.normal(0, 0.2, (4 * size, hidden)), "b": np.zeros(hidden), "u": r.normal(0, 0.2, (hidden, groups)), "d": np.log(np.exp(share).sum(1)), "v": r.normal(0, 0.2, (groups, hidden, wide)), "c": share}
    return {k: x.astype(np.float32) for k, x in p.items()}


def _flat(p: dict) -> np.ndarray:
    return np.concatenate([p[k].reshape(-1) for k in sorted(p)]).astype(np.float32)


def _like(p: dict, flat: np.ndarray) -> dict:
    ends = np.cumsum([p[k].size for k in sorted(p)])
    return {k: x.reshape(p[k].shape).astype(np.float32) for k, x in zip(sorted(p), np.split(flat, ends[:-1]), strict=True)}


def _train(text: DataFrame, heads: dict, hidden: int, size: int, batch: int, rate: float, seed: int) -> dict:
    """The network's parameters after all rounds; in each, tasks learn from their texts and the results are averaged."""
    p = _start(heads, hidden, size, seed)
    total = heads["words"].sum()
    if not total:
        return p
    passes = int(np.clip(np.ceil(LEAST_WORDS / total), 1, PASSES))
    for turn in range(passes * ROUNDS):
        shared = text.sparkSession.sparkContext.broadcast((heads, p))
        fall = rate * 0.5 ** (3 * turn / (passes * ROUNDS))

        def learn(batches, shared=shared, fall=fall, turn=turn):
            heads, p = shared.value
            p = {k: x.copy() for k, x in p.items()}
            state = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in p.items()} | {"step": 0}
            n, r = 0, np.random.default_rng(turn)
            for t in K.chunks(batches, limit=CHUNK_BYTES):
                _, classes, at, _ = _positions(t.column("text"), heads)
                if len(at):
                    # a small chunk is cut into some steps too
                    _learn(p, _inputs(classes, at, len(heads["words"])), classes[at], state, int(np.clip(len(at) // 16, 64, batch)), fall, r)
                    n += len(at)
            if n:
                yield pa.record_batch({"g": pa.array([int(r.integers(16))], pa.int32()), "n": pa.array([float(n)]), "p": pa.array([_flat(p).tobytes()], pa.binary())})

        def mean(t: pa.Table) -> pa.Table:
            n, flat = t.column("n").to_numpy(), sum(x * np.frombuffer(b.as_py(), np.float32).astype(np.float64) for x, b in zip(t.column("n").to_numpy(), t.column("p"), strict=True))
            return pa.table({"n": [n.sum()], "p": pa.array([(flat / n.sum()).astype(np.float32).tobytes()], pa.binary())})

        mine = text.filter(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == turn % ROUNDS)
        got = mine.mapInArrow(learn, "g int, n double, p binary").groupBy("g").applyInArrow(mean, "n double, p binary").collect()
        if got:
            p = _like(p, sum(x.n * np.frombuffer(bytes(x.p), np.float32).astype(np.float64) for x in got) / sum(x.n for x in got))
    return p


def fit(docs: DataFrame, hidden: int = 32, size: int = 16, batch: int = 4096, rate: float = 0.01, seed: int = 5) -> dict:
    """Classes, the network's parameters, and the table of neighbour counts."""
    parts = buckets(docs, each=16 << 20)
    text = docs.select("text")
    heads = _vocabulary(text, parts)
    network = _train(text, heads, hidden, size, batch, rate, seed)

    def count(batches):
        for t in K.chunks(batches):
            words, _, at, first = _positions(t.column("text"), None)
            if len(at):
                single, pair = _keys(words)
                # each row's last word and its border are a pair too, and the border is a word of each row
                ends = at[(first[1:] - 1)[np.diff(first) > 0]]
                yield pa.record_batch(_packed(np.concatenate([single[at], pair[at - 1], pair[ends], single[ends + 1]]), parts))

    kind = "part int, keys binary, n binary"
    counts = settle(text.mapInArrow(count, kind).groupBy("part").applyInArrow(_summed_pairs, kind), "neighbours")
    return {"heads": heads, "network": network, "counts": counts, "parts": parts}


def score(docs: DataFrame, model: dict, own: bool = True, strength: float = 4.0) -> DataFrame:
    """Per row: doc_id, n_words, log_likelihood (sum over words) and mean_log_likelihood.

    own: docs are of the corpus that fitted the model, so each word is left out of the neighbour counts that predict it.
    strength: words that the network's prediction counts for beside the neighbour counts.
    """
    parts, kind = model["parts"], docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model["heads"], model["network"]))

    chunks = buckets(docs, each=CHUNK_BYTES)
    dealt = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk")).repartition(partitions(docs.sparkSession), "chunk")

    def ask(t: pa.Table) -> pa.Table:
        words, _, at, _ = _positions(t.column("text"), None)
        got = _packed(np.concatenate(_keys(words)) if len(at) else np.zeros(0, np.uint64), parts, False)
        return pa.table(got | {"chunk": pa.array(np.full(len(got["part"]), t.column("chunk")[0].as_py() if t.num_rows else 0))})

    def reply(counts: pa.Table, asked: pa.Table) -> pa.Table:
        known = np.concatenate([np.zeros(0, np.uint32), *_unpacked(counts.column("keys"), True)])
        n, held = K.ints(counts.column("n"), np.int64), []
        for blob in asked.column("keys"):
            keys = np.cumsum(_flat_planes(blob), dtype=np.uint32)
            at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
            # a count beyond 32 bits says the same as the largest of them
            held.append(_planes(np.minimum(np.where(known[at] == keys, n[at], 0), 2**32 - 1) if len(known) else np.zeros(len(keys))))
        return pa.table({"chunk": asked.column("chunk"), "part": asked.column("part"), "n": pa.array(held, pa.binary())})

    asked = dealt.groupBy("chunk").applyInArrow(ask, "part int, keys binary, chunk long").groupBy("part")
    replies = model["counts"].groupBy("part").cogroup(asked).applyInArrow(reply, "chunk long, part int, n binary")

    def run(t: pa.Table, answers: pa.Table) -> pa.Table:
        heads, p = shared.value
        words, classes, at, first = _positions(t.column("text"), heads)
        total = np.zeros(len(at) + 1)
        if len(at):
            # the same keys as asked for, in the order of the answers' parts
            keys = np.concatenate(_keys(words))
            by, number = _ranked(((keys % np.uint64(parts)) << np.uint64(32)) | (keys >> np.uint64(32)), parts)
            told = np.concatenate(_unpacked(answers.column("n").take(pa.array(np.argsort(answers.column("part").to_numpy()))), False))
            n = np.empty(len(keys))
            n[by] = told[number]
            single, pair = n[: len(words)], n[len(words) :]
            k, c = {"word": single[at], "before": pair[at - 1], "after": pair[at], "left": single[at - 1], "right": single[at + 1]}, classes[at]
            q, tables = (k["word"] + 1) / (heads["words"][c] + heads["kinds"][c] + 1), _tables(p)
            for low in range(0, len(at), 4096):
                i = at[low : low + 4096]
                q[low : low + 4096] *= _chances(p, tables, _inputs(classes, i, len(heads["words"])), classes[i])
            less = lambda x: np.maximum(x - own, 0)
            side = lambda pair, all_of: (less(k[pair]) + strength * q) / (less(k[all_of]) + strength)
            s = np.log((side("before", "left") + side("after", "right")) / 2)
            np.cumsum(s, out=total[1:])
        n = np.diff(first)
        s = total[first[1:]] - total[first[:-1]]
        return pa.table({"doc_id": t.column("doc_id"), "n_words": pa.array(n.astype(np.int64)), "log_likelihood": pa.array(np.where(n > 0, s, 0.0)), "mean_log_likelihood": pa.array(s / np.maximum(n, 1), mask=n == 0)})

    return dealt.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, f"doc_id {kind}, n_words long, log_likelihood double, mean_log_likelihood double")
