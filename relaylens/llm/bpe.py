"""Byte-level BPE over padded matrices.

A text is cut by the pattern into pieces; each distinct piece is encoded once a batch. Pieces are bucketed by their
length in bytes into padded matrices of token ids. In each round every row merges its leftmost pair of least rank; the
rank of a pair comes from a hash table, rows are compacted in place, and finished rows leave the matrix. A piece that
is a token as a whole is that token. Pieces beyond MATRIX_BYTES are merged by the same rule with a heap, since a row
merges one pair a round.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import bounded_batches, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MATRIX_BYTES = 512
#: Pieces whose ids a Python worker remembers, at some 250 bytes each.
KNOWN = 400_000
#: Cells of a matrix at most: what a round needs beside it is some 40 bytes each.
CELLS = 1 << 18
_NONE = np.int32(2**31 - 1)


class PairTable:
    """Open-addressed hash table from a pair of ids to the id of its merge, which is the merge's rank as well."""

    def __init__(self, ranks: dict[bytes, int]):
        found = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    found.append((a << 32 | b, rank))
        self.found: dict[int, int] | None = None
        keys, values = (np.array(x) for x in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        self.probes, at = 0, self._slot(keys.astype(np.int64))
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]  # of several for one slot the last stays
            own = self.keys[at] == keys
            self.values[at[own]] = values[own]
            keys, values, at = keys[~own], values[~own], (at[~own] + 1) & (len(self.keys) - 1)
            self.probes += 1

    @property
    def rank(self) -> dict[int, int]:
        """The same table for single pairs; made when a piece beyond MATRIX_BYTES first needs it."""
        if self.found is None:
            used = self.keys >= 0
            self.found = dict(zip(self.keys[used].tolist(), self.values[used].tolist()))
        return self.found

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; _NONE where they don't merge or one is padding (negative)."""
        keys = a.astype(np.int64) << 32 | b.astype(np.int64)
        at, out = self._slot(keys), np.full(keys.shape, _NONE, np.int32)
        todo = np.flatnonzero(((a >= 0) & (b >= 0)).ravel())
        keys, at, flat = keys.ravel(), at.ravel(), out.reshape(-1)
        for _ in range(self.probes):
            there = self.keys[at[todo]]
            hit = there == keys[todo]
            flat[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (there != -1)]
            if not len(todo):
                break
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
        return out


class ByteBPE:
    """Encoder and decoder of one vocabulary: ranks as lines of base64 token and rank."""

    def __init__(self, ranks_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks_file.splitlines() if x)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.names = [str(i) for i in range(len(self.tokens))]
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.pairs = PairTable(self.ranks)
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as 32-bit numbers."""
        out = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (whole := self.ranks.get(p)) is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(p) > MATRIX_BYTES:
                out[i] = self._heap(p)
            else:
                buckets.setdefault((len(p) - 1).bit_length(), []).append(i)
        for bits, rows in buckets.items():
            for k in range(0, len(rows), step := max(1, CELLS >> bits)):
                for i, ids in zip(rows[k : k + step], self._matrix([pieces[i] for i in rows[k : k + step]])):
                    out[i] = ids
        return out

    def _matrix(self, pieces: list[bytes]) -> list[bytes]:
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max())
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        ids = np.where(np.arange(width) < lengths[:, None], self.bytes[raw], np.int32(-1))
        rank = self.pairs(ids[:, :-1], ids[:, 1:])
        done = [b""] * len(pieces)
        rows = np.arange(len(pieces))
        while True:
            at = rank.argmin(1) if rank.shape[1] else np.zeros(len(rows), np.int64)  # the leftmost of the least
            best = rank[np.arange(len(rows)), at] if rank.shape[1] else np.full(len(rows), _NONE)
            over = best == _NONE
            if over.any():
                for r, x, n in zip(rows[over], ids[over], lengths[over]):
                    done[r] = x[:n].tobytes()
                rows, ids, rank, lengths, at, best = (x[~over] for x in (rows, ids, rank, lengths, at, best))
            if not len(rows):
                return done
            lengths = lengths - 1
            width = int(lengths.max())
            here, each = np.arange(width), np.arange(len(rows))
            moved = here + (here > at[:, None])  # what stood right of the pair moves one to the left
            ids = np.where(here < lengths[:, None], np.take_along_axis(ids, np.minimum(moved, ids.shape[1] - 1), 1), np.int32(-1))
            ids[each, at] = best
            gaps = np.arange(width - 1)
            rank = np.take_along_axis(rank, np.minimum(gaps + (gaps >= at[:, None]), rank.shape[1] - 1), 1) if width > 1 else np.empty((len(rows), 0), np.int32)
            rank[gaps >= lengths[:, None] - 1] = _NONE
            for side in (at - 1, at):
                ok = np.flatnonzero((side >= 0) & (side < lengths - 1))
                rank[ok, side[ok]] = self.pairs(ids[ok, side[ok]], ids[ok, side[ok] + 1])

    def _heap(self, piece: bytes) -> bytes:
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        n, rank = len(ids), self.pairs.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank.get(ids[i] << 32 | ids[j]) != r:
                continue
            ids[i], ids[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (x := rank.get(r << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (x, i))
            if (h := before[i]) >= 0 and (x := rank.get(ids[h] << 32 | r)) is not None:
                heapq.heappush(heap, (x, h))
        return np.array([x for x in ids if x >= 0], np.int32).tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that aren't known yet. What is remembered is bounded."""
        if len(self.known) > KNOWN:
            self.known.clear()
        new = [p for p in pieces if p not in self.known]
        for p, ids in zip(new, self.encode_pieces([p.encode("utf-8", "replace") for p in new])):
            self.known[p] = ids

    def encode(self, text: str) -> list[int]:
        pieces = self.find(text)
        self.learn(set(pieces))
        return self.ids(pieces)

    def ids(self, pieces: list[str]) -> list[int]:
        """The ids of pieces that are known."""
        return np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), np.int32).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_MADE: dict[tuple[int, str], ByteBPE] = {}


def coder(ranks_file: bytes, pattern: str) -> ByteBPE:
    """One coder a Python worker and vocabulary."""
    key = (hash(ranks_file), pattern)
    if key not in _MADE:
        _MADE[key] = ByteBPE(ranks_file, pattern)
    return _MADE[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, keep: list[str], with_ids: bool = False) -> DataFrame:
    """The columns `keep` of docs with n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids.

    Null counts as empty: no tokens, the digests of nothing. A kept column called like a new one gives way to it.
    ranks_path is a file of the driver's; its bytes (under 1 MB) travel with the function.
    """
    with open(ranks_path, "rb") as f:
        ranks_file = f.read()
    new = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    if with_ids:
        from pyspark.sql.types import ArrayType, IntegerType

        new.append(StructField("ids", ArrayType(IntegerType())))
    keep = [k for k in keep if k not in {f.name for f in new}]
    schema = StructType([*docs.select(*keep).schema, *new])

    def rows(batches):
        bpe = coder(ranks_file, pattern)
        sha = hashlib.sha256
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                pieces = [bpe.find(t or "") for t in part.column("text").to_pylist()]
                bpe.learn(set().union(*pieces))
                n, ids_sha, decoded, all_ids = [], [], [], []
                for p in pieces:
                    ids = bpe.ids(p)
                    n.append(len(ids))
                    ids_sha.append(sha(",".join(map(bpe.names.__getitem__, ids)).encode()).hexdigest())
                    decoded.append(sha(bpe.decode(ids)).hexdigest())
                    if with_ids:
                        all_ids.append(ids)
                more = [pa.array(all_ids, pa.list_(pa.int32()))] if with_ids else []
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded, pa.string()), *more], schema.names)

    return bounded_batches(docs).select(*dict.fromkeys(["text", *keep])).mapInArrow(rows, schema)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, ["doc_id"])
