"""Numpy kernels over Arrow string columns: words, word hashes, rolling window hashes.

They run inside Spark tasks on bounded chunks of whole texts. Hashes are polynomial, mod 2**64, with fixed random
byte values, so every task gives the same word the same hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
#: Text bytes that one chunk of documents gathers (a longer document is a chunk of its own).
CHUNK_BYTES = 6 << 20
SEGMENT = 1 << 20
BYTE_VALUES = np.random.default_rng(20240521).integers(1, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
R_BYTE, R_WORD = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i < n."""
    with np.errstate(over="ignore"):
        up, down = np.full(n, base, U), np.full(n, pow(base, -1, 1 << 64), U)
        up[:1] = down[:1] = 1
        return np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def string_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of an Arrow string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    n = len(column)
    _, offsets, data = column.buffers()
    if not n or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def spans(is_gap: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs outside gaps, none across a row's border, and the first run of each row (rows + 1)."""
    n = len(is_gap)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], after[-1] = True, True
    before[1:], after[:-1] = is_gap[:-1], is_gap[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner], after[inner - 1] = True, True
    starts, ends = np.flatnonzero(~is_gap & before), np.flatnonzero(~is_gap & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """A 64-bit hash of each span's bytes (spans in order, not overlapping)."""
    out, i = np.empty(len(starts), U), 0
    up, down = powers(R_BYTE, SEGMENT)
    with np.errstate(over="ignore"):
        while i < len(starts):
            at = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, at + SEGMENT, "right")))
            size = int(ends[j - 1] - at)
            if size > len(up):
                up, down = powers(R_BYTE, size)
            total = np.zeros(size + 1, U)
            np.cumsum(values[buf[at : at + size]] * up[:size], out=total[1:])
            s, e = starts[i:j] - at, ends[i:j] - at
            out[i:j] = (total[e] - total[s]) * down[s]
            i = j
        return mix(out ^ mix((ends - starts).astype(U)))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each window of k consecutive entries (of all rows in one sequence)."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, U)
    with np.errstate(over="ignore"):
        up, down = powers(R_WORD, n)
        total = np.zeros(n + 1, U)
        np.cumsum(hashes * up, out=total[1:])
        return mix((total[k:] - total[:-k]) * down[: n - k + 1])


def sliding(x: np.ndarray, w: int, best=np.minimum) -> np.ndarray:
    """Minimum (or maximum) of each w consecutive entries."""
    have, out = 1, x
    while have * 2 <= w:
        out, have = best(out[:-have], out[have:]) if len(out) > have else out[:0], have * 2
    if have < w and len(out):
        out = best(out[: len(out) - (w - have)], out[w - have :]) if len(out) > w - have else out[:0]
    return out


def words_of(column, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words between ASCII white space, and the first word of each row (rows + 1)."""
    buf, offsets = string_buffers(column)
    starts, ends, first = spans(SPACES[buf], offsets)
    return span_hashes(buf, starts, ends, BYTE_VALUES[LOWER] if lower else BYTE_VALUES), first


def windows_of(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and row of each window of k words within one row, and its first word's place in the sequence."""
    all_of = rolling(hashes, k)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = np.flatnonzero(row[: len(all_of)] == row[k - 1 :]) if len(all_of) else np.zeros(0, np.int64)
    return all_of[inside], row[inside], inside


def chunks(batches, text: str = "text", limit: int = CHUNK_BYTES):
    """Arrow tables of whole rows with about limit bytes of text each."""
    held, size = [], 0
    for batch in batches:
        at = 0
        if not batch.num_rows:
            continue
        lengths = np.diff(string_buffers(batch.column(batch.schema.get_field_index(text)))[1])
        ends = np.cumsum(lengths)
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            n = max(1, int(np.searchsorted(ends, done + limit - size, "right")) - at)
            held.append(batch.slice(at, n))
            size += int(ends[at + n - 1]) - done
            at += n
            if size >= limit or at < batch.num_rows:
                table, held, size = pa.Table.from_batches(held), [], 0
                yield table
                del table
    if held:
        yield pa.Table.from_batches(held)


def ints(blobs, kind) -> np.ndarray:
    """The arrays in a binary column, end to end."""
    buf, _ = string_buffers(blobs)
    return buf.view(kind) if len(buf) else np.zeros(0, kind)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct entries (by sorting, which is faster than numpy's hash table on large arrays)."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by key and the places in it where a key begins, closed by the length."""
    order = np.argsort(key, kind="stable")
    s = key[order]
    return order, np.append(np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else [], len(s)).astype(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, end to end."""
    total = np.cumsum(lengths) - lengths
    return np.repeat(starts - total, lengths) + np.arange(int(lengths.sum()))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Root (the smallest member) of each of n vertices under the links a-b."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        moved = low < high
        if not moved.any():
            break
        np.minimum.at(root, high[moved], low[moved])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        a, b = a[moved], b[moved]
    return root
