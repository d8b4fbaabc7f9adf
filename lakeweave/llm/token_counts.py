"""Token counts of documents, by counting the pieces of each distinct pre-token once.

1. Texts are cut into pre-tokens slice by slice. A slice gives one row for each of its distinct pre-tokens, with postings:
   (document in the slice, frequency) pairs. So a frequent pre-token costs a row for each slice, not for each occurrence.
2. Rows are dealt by pre-token and sorted, so that equal ones stand together; the tokenizer counts each distinct one's
   pieces (their number only: no ids are kept or moved), and pieces * frequency is added up for each document.
3. A task hands on, for each slice, the sums of its documents in one packed row; these are added up slice by slice.

What moves follows the number of distinct pre-tokens in slices, and a slice's rows never need more memory than the slice.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pretokens import SLICE_BYTES, Pretokens, added_tokens
from .words import buffers, chunks, mix64, tidy

LIMIT = 1024
#: Documents in a slice at most: postings hold 16-bit numbers.
_SLICE_ROWS = 1 << 16
#: Partial sums that a counting task holds before it hands them on.
_HELD = 1 << 20
_POSTING = np.dtype([("doc", "<u2"), ("freq", "u1")])
_SUM = np.dtype([("doc", "<u2"), ("n", "<u8")])
def row_slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    for a, b in chunks(offsets, most):
        for c in range(a, b, _SLICE_ROWS):
            yield c, min(b, c + _SLICE_ROWS)


#: Rows of slices (part: what they are dealt by; pretoken and postings, or docs: an Arrow stream of id, n_bytes and special)
#: and packed sums (or docs). Docs is one binary column, as nulls in nested ones cost the JVM quadratic time.
ROWS = "part int, base long, pretoken binary, postings binary, docs binary"
SUMS = "base long, sums binary, docs binary"
_ROWS = pa.schema([("part", pa.int32()), ("base", pa.int64()), ("pretoken", pa.binary()), ("postings", pa.binary()), ("docs", pa.binary())])
_SUMS = pa.schema([("base", pa.int64()), ("sums", pa.binary()), ("docs", pa.binary())])


def _stream(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _postings(p: Pretokens) -> pa.Array:
    pair, freq = np.unique(p.which.astype(np.int64) << 16 | p.row, return_counts=True)
    if len(freq) and freq.max() > 0xFF:  # more than a byte holds: in several postings
        times = -(-freq // 0xFF)
        rest = freq - (times - 1) * 0xFF
        pair, last = np.repeat(pair, times), np.cumsum(times) - 1
        freq = np.full(len(pair), 0xFF)
        freq[last] = rest
    packed = np.empty(len(pair), _POSTING)
    packed["doc"], packed["freq"] = pair & 0xFFFF, freq
    ends = np.searchsorted(pair >> 16, np.arange(len(p.texts) + 1)).astype(np.int32) * _POSTING.itemsize
    return pa.Array.from_buffers(pa.binary(), len(p.texts), [None, pa.py_buffer(ends), pa.py_buffer(packed)])


@tidy
def _read(batches: Iterator[pa.RecordBatch], added: tuple[bytes, ...]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 40  # the same again if the task is run again
    for batch in batches:
        offsets, data = buffers(batch.column(1))
        for a, b in row_slices(offsets):
            p = Pretokens(offsets[a : b + 1], data[offsets[a] : offsets[b]], added)
            own = pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(offsets[a : b + 1])), pa.array(p.special)], names=["id", "n_bytes", "special"])
            part = int(mix64(np.array([base], np.uint64))[0] >> np.uint64(33))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([base]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([_stream(own)], pa.binary())], schema=_ROWS)
            n = len(p.texts)
            parts = (p.key >> np.uint64(32)).astype(np.uint32).view(np.int32)
            out = pa.RecordBatch.from_arrays([pa.array(parts), pa.array(np.full(n, base)), pa.array(p.texts, pa.binary()), _postings(p), pa.nulls(n, pa.binary())], schema=_ROWS)
            for i in range(0, n, 20_000):
                yield out.slice(i, 20_000)
            base += 1 << 16


@functools.lru_cache(2)
def _tokenizer(spec: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_str(spec)
    found.no_truncation()
    found.no_padding()
    return found


@tidy
def _count(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    """Packed sums of pieces * frequency for each slice; rows that describe documents are passed on."""
    tokenizer = _tokenizer(spec)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, known, pieces = 0, b"", 0

    def summed() -> tuple[np.ndarray, np.ndarray]:
        at, where = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        return at, np.bincount(where, np.concatenate([n for _, n in held]), len(at)).astype(np.int64)

    def packed(at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        sums = np.empty(len(at), _SUM)
        sums["doc"], sums["n"] = at & 0xFFFF, n
        bases, first = np.unique(at >> 16, return_index=True)
        ends = np.append(first, len(at)).astype(np.int32) * _SUM.itemsize
        return pa.RecordBatch.from_arrays([pa.array(bases << 16), pa.Array.from_buffers(pa.binary(), len(bases), [None, pa.py_buffer(ends), pa.py_buffer(sums)]), pa.nulls(len(bases), pa.binary())], schema=_SUMS)

    for batch in batches:
        own = batch.column("pretoken").is_null()
        if own.true_count:
            d = batch.filter(own)
            yield pa.RecordBatch.from_arrays([d.column("base"), pa.nulls(len(d), pa.binary()), d.column("docs")], schema=_SUMS)
            batch = batch.filter(batch.column("pretoken").is_valid())
        if not len(batch):
            continue
        coded = batch.column("pretoken").dictionary_encode()
        new = coded.dictionary.to_pylist()
        todo = [x for x in new if x != known]  # the first may have begun in the batch before
        found = dict(zip(todo, map(len, tokenizer.encode_batch_fast([x.decode() for x in todo], add_special_tokens=False)), strict=True))
        found.setdefault(known, pieces)
        n = np.array([found[x] for x in new], np.int64)[coded.indices.to_numpy()]
        known, pieces = new[-1], found[new[-1]]
        postings = batch.column("postings")
        ends = np.frombuffer(postings.buffers()[1], np.int32, len(postings) + 1, postings.offset * 4)
        pairs = np.frombuffer(postings.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(_POSTING)
        times = np.diff(ends) // _POSTING.itemsize
        held.append((np.repeat(batch.column("base").to_numpy(), times) + pairs["doc"], np.repeat(n, times) * pairs["freq"]))
        size += len(pairs)
        if size > 2 * _HELD:
            held = [summed()]
            size = len(held[0][0])
            if size > _HELD:
                yield packed(*held[0])
                held, size = [], 0
    if held:
        yield packed(*summed())


@tidy
def _total(batches: Iterator[pa.RecordBatch], limit: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Adds up a slice's packed sums; its rows stand together, the one that describes its documents first."""
    docs, n = None, np.zeros(0, np.int64)

    def out() -> pa.RecordBatch:
        ids, sizes, special = docs
        total = n + special.to_numpy()
        return pa.RecordBatch.from_arrays([ids.cast(schema.field(0).type), sizes, pa.array(total), pa.array(total > limit)], schema=schema)

    for batch in batches:
        about = batch.column("docs")
        for i, sums in enumerate(batch.column("sums").to_pylist()):
            if sums is None:
                if docs is not None:
                    yield out()
                docs = pa.ipc.open_stream(about[i].as_py()).read_all().combine_chunks().columns
                docs = [c.chunk(0) if c.num_chunks else pa.nulls(0, c.type) for c in docs]
                n = np.zeros(len(docs[0]), np.int64)
            else:
                found = np.frombuffer(sums, _SUM)
                n[found["doc"]] += found["n"].astype(np.int64)
    if docs is not None:
        yield out()


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row for each row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Tokens are those of the library for a byte-level ``tokenizers`` file, without special tokens around the text; an added token's
    text inside a text is one token, as is the library's default. Null counts as empty: no bytes, no tokens. Repeated rows
    and repeated ids keep a row each. An empty table gives an empty result. Other columns are not read.
    The file (a few MB) is read on the driver and sent along.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    added = tuple(x.encode() for x in added_tokens(tokenizer_path))
    kind = docs.schema[id_col].dataType
    out = T.StructType([T.StructField(id_col, kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    out_schema = to_arrow_schema(out)
    read = docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(lambda it: _read(it, added), ROWS)
    counted = read.repartition("part").sortWithinPartitions("part").mapInArrow(lambda it: _count(it, spec), SUMS)
    together = counted.repartition("base").sortWithinPartitions("base", F.col("sums").isNotNull())
    return together.mapInArrow(lambda it: _total(it, limit, out_schema), out)


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
