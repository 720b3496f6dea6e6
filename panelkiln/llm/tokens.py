"""Token ids by a public byte-level BPE vocabulary, computed once for each distinct piece of text in a chunk.

A text is cut in front of a single space or line break between two other characters. The vocabulary's own pattern
always has a border there, so the pieces' ids, end to end, are the text's ids.
"""

from __future__ import annotations

import base64
import os
from itertools import chain

import numpy as np

from . import kernels as K


#: Text bytes that one chunk encodes: pieces and ids take some 40 times as much while they are Python objects.
CHUNK_BYTES = 2 << 20


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _pieces(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pieces; they cover all bytes."""
    n = len(buf)
    own = offsets[:-1][np.diff(offsets) > 0]
    if n < 4:
        return own
    at = np.flatnonzero((buf == 32) | (buf == 10))
    at = at[(at > 1) & (at < n - 1)]
    before, earlier, after = buf[at - 1], buf[at - 2], buf[at + 1]
    # control characters 28-31 count as white space; bytes of non-ASCII white space are left uncut as well
    plain = lambda x: (x > 32) & (x != 127)
    fine = plain(before) & plain(after) & ~((before > 127) & np.isin(earlier, (0xC2, 0x80, 0x81, 0x9A))) & ~np.isin(after, (0xC2, 0xE1, 0xE2, 0xE3))
    at = at[fine]
    return K.distinct(np.concatenate([own, at]))


class Ids:
    """Ids of texts; keeps the ids of pieces seen, up to `most` of them (some 30 bytes each).

    path: a vocabulary file of `tokenizers`. Where the same vocabulary lies beside it as ranks (.tiktoken), plain pieces are
    encoded from the ranks, which gives the same ids in a third of the time; pieces that may hold a special token's string are not.
    """

    def __init__(self, path: str, most: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.ranks = Tokenizer.from_file(path), most, None
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        beside = path.removesuffix(".json") + ".tiktoken"
        if path.endswith(".json") and os.path.exists(beside):
            import public_tokenizers
            import tiktoken

            with open(beside, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.forget()

    def encode(self, pieces: list[str]) -> list[list[int]]:
        if self.ranks is None:
            return [x.ids for x in self.batch(pieces, add_special_tokens=False)]
        one = self.ranks.encode_ordinary
        return [one(p) if "<|" not in p else self.tokenizer.encode(p, add_special_tokens=False).ids for p in pieces]

    def forget(self):
        self.keys, self.first, self.count, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def of(self, column) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and where each row's begin (rows + 1)."""
        buf, offsets = K.string_buffers(column)
        starts = _pieces(buf, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(buf))
        hashes = K.span_hashes(buf, starts, ends)
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > self.most:
            self.forget()
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        known[at < len(self.keys)] = self.keys[at[at < len(self.keys)]] == unique[at < len(self.keys)]
        if not known.all():
            data, new = buf.tobytes(), first[~known]
            ids = self.encode([data[s:e].decode("utf-8", "replace") for s, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            count = np.fromiter(map(len, ids), np.int64, len(ids))
            self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(count) - count])
            self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum()))])
            self.keys, self.count = np.concatenate([self.keys, unique[~known]]), np.concatenate([self.count, count])
            order = np.argsort(self.keys, kind="stable")
            self.keys, self.first, self.count = self.keys[order], self.first[order], self.count[order]
            at = np.searchsorted(self.keys, unique)
        piece = at[back]
        count = self.count[piece]
        ends_of = np.append(0, np.cumsum(count))
        return self.pool[K.ranges(self.first[piece], count)], ends_of[np.searchsorted(starts, offsets)]
