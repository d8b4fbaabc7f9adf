import hashlib
import random

import pyarrow as pa
import pytest
from helpers import rows, table, thue_morse

import numpy as np
from lakeweave.llm import bpe, pretokens, token_counts
from lakeweave.llm.pretokens import PATTERN, Pretokens
from lakeweave.llm.words import buffers, shingle_sets

P = pytest.importorskip("public_tokenizers")
PIECES = ["a", "b", "'", "s", "'re", "'ll", "'d", "r", "e", "l", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "é", "1", "²", "!", '"', "😀", "漢", "<|endoftext|>", "\r\n", "'S", "\u0301"]


def texts(n, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, 14))) for _ in range(n)] + [None, "", "ab" * 30_000]


def test_pattern_is_that_of_the_files():
    assert PATTERN == P.PATTERN


def test_cut_equals_the_pattern():
    import regex

    data = texts(5000)
    p = Pretokens(*buffers(pa.array(data, pa.string())))
    got = [[] for _ in data]
    for row, which in zip(p.row, p.which, strict=True):
        got[row].append(p.texts[which].decode())
    assert got == [regex.findall(PATTERN, t or "") for t in data]


def test_encoder_equals_the_library():
    import tiktoken

    encoder = bpe._encoder(open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    data = texts(1500) + ["a" * 3000, "lorem" * 500]
    for i, ids in bpe.encode_column(pa.array(data, pa.string()), encoder):
        assert ids == library.encode_ordinary(data[i] or "") and encoder.decode(ids) == (data[i] or "").encode()
    for word in ("unbelievable", "aaaaaaa", "😀😀", "xyzzy" * 9):
        assert encoder._merge_alone(word.encode()) == encoder._merge([word.encode()])[0].tolist()


@pytest.mark.parametrize("swap", [False, True])
def test_texts_that_hash_alike_stay_apart(spark, swap, monkeypatch):
    from tokenizers import Tokenizer

    pair = thue_morse()[:: -1 if swap else 1]
    assert len({s.tobytes() for s in shingle_sets(pa.array(pair))}) == 2
    data = [(i, t, "s") for i, t in enumerate(pair * 2)]
    got = bpe.encode_documents(table(spark, data), P.path("byte_bpe_multi_50k.tiktoken"), digests=True).collect()
    assert all(r.decoded_sha256 == hashlib.sha256(data[r.doc_id][1].encode()).hexdigest() for r in got) and len(got) == 4
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    counts = token_counts.count_tokens(table(spark, data), P.path("byte_bpe_50k.json")).collect()
    assert {r.doc_id: r.n_tokens for r in counts} == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t, _ in data}
    # long pre-tokens that all share one of three hashes
    real = pretokens.hash_spans
    monkeypatch.setattr(pretokens, "hash_spans", lambda d, s, e: np.where(e - s > 8, real(d, s, e) % np.uint64(3), real(d, s, e)))
    r = random.Random(4)
    words = ["pretoken" + str(i) for i in range(30)] + ["ab", "cd"]
    texts_ = [" ".join(r.choice(words) for _ in range(50)) for _ in range(40)]
    p = Pretokens(*buffers(pa.array(texts_)))
    assert len(set(p.texts)) == len(p.texts) == len(p.key)
    assert ["".join(p.texts[w].decode() for w in p.which[p.row == i]) for i in range(len(texts_))] == texts_


def test_rank_set():
    s, r = bpe.RankSet(300_000), random.Random(1)
    held = set()
    for _ in range(3000):
        x = r.randrange(300_000)
        (s.drop, held.discard)[0](x) if x in held else s.add(x)
        held ^= {x}
        assert s.lowest() == min(held, default=-1)


def test_encoding_tables(spark):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe._encoder(open(path, "rb").read()).ranks, special_tokens={})
    want = sorted(((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t, _ in rows()), key=str)
    got = bpe.encode_documents(table(spark), path, digests=True).collect()
    assert sorted(((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got), key=str) == want
    assert all(r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(r.decoded).hexdigest() for r in got)
    assert bpe.encode_documents(table(spark, []), path).collect() == []


def test_counts(spark):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    data = rows() + [(200 + i, t, "x") for i, t in enumerate(texts(300))]
    want = sorted(((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 50) for i, t, _ in data), key=str)
    got = token_counts.count_tokens(table(spark, data), path, limit=50)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert token_counts.count_tokens(table(spark, []), path).collect() == []


def test_shingle_sets_have_the_right_sizes_and_overlaps():
    from helpers import shingles

    data = [t for _, t, _ in rows()]
    sets = list(shingle_sets(pa.array(data, pa.string())))
    plain = [shingles(t) for t in data]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    assert all(len(set(a) & set(b)) == len(x & y) for a, x in zip(sets[:12], plain[:12], strict=True) for b, y in zip(sets, plain, strict=True))
