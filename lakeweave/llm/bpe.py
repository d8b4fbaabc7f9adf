"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

All distinct pre-tokens of a slice of texts are merged together, as one linked list of tokens with a border after each
pre-token. A bucket for each merge rank holds the list positions at which a pair of that rank begins (or began). A
bitmap over ranks, with a bit for each non-empty bucket, and bitmaps over its words give the lowest non-empty rank by
find-first-set in a few steps. The whole bucket is merged at once, from left to right; entries whose pair is gone are
skipped. A merge changes its neighbours' pairs, which go into their buckets. A pre-token of n bytes takes O(n) entries, however long.

Merging a bucket at once is right as long as no merge brings up a pair of a rank not above its own. A pre-token in which
one does is merged again alone, entry by entry (``_merge_alone``).
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pretokens import Pretokens
from .words import buffers, chunks, tidy

#: Texts are encoded in slices of at most so many bytes (a longer text alone), and handed on when results come to as many.
SLICE_BYTES = 6 << 20


class RankSet:
    """A set of ranks as bitmaps of 64-bit words, each level with a bit for every non-empty word below."""

    def __init__(self, size: int) -> None:
        self.levels: list[list[int]] = []
        while True:
            size = -(-size // 64)
            self.levels.append([0] * size)
            if size <= 1:
                break

    def add(self, rank: int) -> None:
        for words in self.levels:
            at, bit = rank >> 6, 1 << (rank & 63)
            if words[at] & bit:
                return
            words[at] |= bit
            rank = at

    def drop(self, rank: int) -> None:
        for words in self.levels:
            at = rank >> 6
            words[at] &= ~(1 << (rank & 63))
            if words[at]:
                return
            rank = at

    def lowest(self) -> int:
        """The lowest rank, or -1."""
        if not self.levels[-1] or not self.levels[-1][0]:
            return -1
        at = 0
        for words in reversed(self.levels):
            word = words[at]
            at = at << 6 | (word & -word).bit_length() - 1
        return at


class Encoder:
    """Encodes pre-tokens by a table token -> rank, the rank being the id."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        self.tokens: list[bytes] = [b""] * self.size
        pairs, merged = [], []
        for token, rank in ranks.items():
            self.tokens[rank] = token
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    merged.append(rank)
        order = np.argsort(np.array(pairs, np.int64))
        self.pairs = np.append(np.array(pairs, np.int64)[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.array(merged, np.int64)[order], -1)
        self.joined = dict(zip(pairs, merged, strict=True))
        self.decimal = [str(i) for i in range(self.size)]

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, -1 if it doesn't merge; an id of -1 stands for a border."""
        key = a << 32 | (b & 0xFFFFFFFF)
        at = np.searchsorted(self.pairs, key)
        return np.where((self.pairs[at] == key) & (b >= 0), self.merged[at], -1)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of piece i are ids[ends[i]:ends[i + 1]]."""
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        rest = [p for p, w in zip(pieces, whole.tolist(), strict=True) if w < 0]
        ids, ends = self._merge(rest)
        count = np.ones(len(pieces), np.int64)
        count[whole < 0] = np.diff(ends)
        out_ends = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(out_ends[-1], np.int64)
        out[out_ends[:-1][whole >= 0]] = whole[whole >= 0]
        out[np.repeat(whole < 0, count)] = ids
        return out, out_ends

    def _merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(data)
        stops = np.cumsum([len(p) for p in pieces], dtype=np.int64) if pieces else np.zeros(0, np.int64)
        starts = np.concatenate([[0], stops[:-1]]) if pieces else stops
        token = np.append(self.byte[data], -1)  # place n is the border
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[stops[stops > starts] - 1] = n
        before = np.append(before, 0)[: n + 1]
        before[starts[stops > starts]] = n
        rank = np.append(self.pair_ranks(token[:n], token[after[:n]]), -1)
        alive = np.ones(n, bool)
        buckets: dict[int, list[int]] = {}
        waiting = RankSet(self.size)
        odd: set[int] = set()
        order = np.argsort(rank[:n], kind="stable")
        order = order[np.searchsorted(rank[order], 0) :]
        found, at = np.unique(rank[order], return_index=True)
        bounds = [*at.tolist(), len(order)]
        for i, r in enumerate(found.tolist()):
            buckets[r] = order[bounds[i] : bounds[i + 1]].tolist()
            waiting.add(r)
        while (r := waiting.lowest()) >= 0:
            waiting.drop(r)
            entries = buckets.pop(r)
            p = np.array(entries, np.int64)
            p = p[rank[p] == r]  # the others are stale
            if len(p) > 1:
                p = np.unique(p)
                chained = p[1:] == after[p[:-1]]
                if chained.any():  # of pairs that share a token the left ones merge
                    place = np.arange(len(p))
                    head = np.maximum.accumulate(np.where(np.append(True, ~chained), place, 0))
                    p = p[(place - head) % 2 == 0]
            if not len(p):
                continue
            q = after[p]
            s = after[q]
            alive[q] = False
            rank[q] = -1
            token[p] = r
            after[p] = s
            before[s] = p
            ahead = before[p]
            ahead = ahead[ahead != n]
            changed = np.concatenate([p, ahead])
            new = self.pair_ranks(token[changed], token[after[changed]])
            rank[changed] = new
            if ((new >= 0) & (new <= r)).any():
                odd.update(np.searchsorted(stops, changed[(new >= 0) & (new <= r)], "right").tolist())
            for x, k in zip(changed.tolist(), new.tolist(), strict=True):
                if k >= 0:
                    if (held := buckets.get(k)) is None:
                        buckets[k] = [x]
                        waiting.add(k)
                    else:
                        held.append(x)
        made = np.concatenate([[0], np.cumsum(alive)])
        ids, ends = token[:n][alive], np.append(made[starts], made[n]) if len(starts) else np.zeros(1, np.int64)
        if odd:
            parts = [ids[ends[i] : ends[i + 1]] for i in range(len(pieces))]
            for i in odd:
                parts[i] = np.array(self._merge_alone(pieces[i]), np.int64)
            ids, ends = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        return ids, ends

    def _merge_alone(self, piece: bytes) -> list[int]:
        """The lowest rank's leftmost pair first, one at a time."""
        n = len(piece)
        token = [*self.byte[np.frombuffer(piece, np.uint8)].tolist(), -1]
        after, before = [*range(1, n + 1), n], [n, *range(n)]
        rank = [*self.pair_ranks(np.array(token[:n]), np.array(token[1:])).tolist(), -1]
        buckets: dict[int, list[int]] = {}
        waiting = RankSet(self.size)
        for p in range(n):
            if rank[p] >= 0:
                buckets.setdefault(rank[p], []).append(p)  # in order, so already a heap
                waiting.add(rank[p])
        while (r := waiting.lowest()) >= 0:
            p = heapq.heappop(buckets[r])
            if not buckets[r]:
                del buckets[r]
                waiting.drop(r)
            if rank[p] != r:
                continue
            q = after[p]
            token[p], after[p], rank[q], token[q] = r, after[q], -1, -2
            before[after[p]] = p
            for x in {p, before[p]} - {n}:
                rank[x] = self.joined.get(token[x] << 32 | token[after[x]], -1) if after[x] < n else -1
                if rank[x] >= 0:
                    heapq.heappush(buckets.setdefault(rank[x], []), x)
                    waiting.add(rank[x])
        return [t for t in token[:n] if t >= 0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(2)
def _encoder(table: bytes) -> Encoder:
    import base64

    return Encoder({base64.b64decode(a): int(b) for a, b in (x.split() for x in table.splitlines() if x.strip())})


def encode_column(column: pa.Array, encoder: Encoder) -> Iterator[tuple[int, list[int]]]:
    """(row, ids) of each text; a null is an empty text."""
    offsets, data = buffers(column)
    for a, b in chunks(offsets, SLICE_BYTES):
        p = Pretokens(offsets[a : b + 1], data[offsets[a] : offsets[b]])
        ids, ends = encoder.encode(p.texts)
        first = np.searchsorted(p.row, np.arange(b - a + 1))
        count = np.diff(ends)
        for i in range(b - a):
            w = p.which[first[i] : first[i + 1]]
            n = count[w]
            total = int(n.sum())
            shift = np.repeat(ends[w] - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(w) else ends[w], n)
            yield a + i, ids[shift + np.arange(total)].tolist()


def encode_documents(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, decoded: bool = True, digests: bool = False) -> DataFrame:
    """One row for each row of ``docs``: id, n_tokens; with ``ids`` also ids (array<int>), with ``decoded`` also decoded (binary: the
    ids decoded again, which is the text's UTF-8); with ``digests`` ids_sha256 (of the decimal ids joined by commas) and decoded_sha256.

    Every match of the pattern is encoded alone, without special tokens. Null counts as empty: no tokens. Repeated rows keep a
    row each. An empty table gives an empty result. Other columns are not read. The vocabulary (a few MB) is sent along.
    """
    with open(ranks_path, "rb") as f:
        table = f.read()
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids + [T.StructField("decoded", T.BinaryType())] * decoded
    fields += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())] * digests
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(T.StructType(fields))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(table)
        for batch in batches:
            rows: list[list] = [[] for _ in fields[1:]]
            size = start = 0
            for i, found in encode_column(batch.column(1), encoder):
                text = encoder.decode(found) if decoded or digests else b""
                row = [len(found)]
                if ids:
                    row.append(pa.array(found, pa.int32()))
                    size += 4 * len(found)
                if decoded:
                    row.append(text)
                    size += len(text)
                if digests:
                    row += [hashlib.sha256(",".join(map(encoder.decimal.__getitem__, found)).encode()).hexdigest(), hashlib.sha256(text).hexdigest()]
                for held, x in zip(rows, row, strict=True):
                    held.append(x)
                if size > SLICE_BYTES or i + 1 == len(batch):
                    yield _batch(batch.column(0).slice(start, i + 1 - start), rows, schema, ids)
                    rows, size, start = [[] for _ in fields[1:]], 0, i + 1

    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, T.StructType(fields))


def _batch(own: pa.Array, rows: list[list], schema: pa.Schema, ids: bool) -> pa.RecordBatch:
    columns = [own.cast(schema.field(0).type)]
    for j, held in enumerate(rows):
        kind = schema.field(j + 1).type
        if ids and j == 1:
            ends = np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(held)).cast(kind))
        else:
            columns.append(pa.array(held, kind))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), ids=False, decoded=False, digests=True)
