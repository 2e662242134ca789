"""Byte-level BPE against the tiktoken library, packing against its contract."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pastline.llm import bpe, packing

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


#: Tiny leaves, so that every text goes through many joins.
SMALL = bpe.TreeBpe(bpe.load(RANKS, P.PATTERN).ranks, P.PATTERN, leaf_bytes=1, leaf_chars=4)


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'stlrev 1é中\n\t!$\x1c\u0085 ́й😀A")), max_size=80))
def test_joins_equal_the_library(text):
    with open(RANKS, "rb"):
        enc = _LIBRARY()
    assert ids(SMALL, text) == enc.encode_ordinary(text)
    assert SMALL.decode(ids(SMALL, text)) == text.encode()


_held = []


def _LIBRARY():
    if not _held:
        _held.append(tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=SMALL.ranks, special_tokens={}))
    return _held[0]


def test_long_runs_equal_the_library(library):
    draw = random.Random(3)
    for text in ("a" * 3000, "ab" * 2000, " " * 999 + "x", "!" * 2049, "中文" * 500, "".join(draw.choices("abcdefgh", k=3000)), "the" * 700):
        assert ids(bpe.load(RANKS, P.PATTERN), text) == ids(SMALL, text) == library.encode_ordinary(text)


def test_bpe_documents(documents, edge_rows, library):
    got = bpe.bpe_documents(documents(edge_rows), RANKS, P.PATTERN).collect()
    want = []
    for i, t, *_ in edge_rows:
        x = library.encode_ordinary(t or "")
        want.append((i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), True))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert bpe.bpe_documents(documents([]), RANKS, P.PATTERN).count() == 0


def pieces_hold(rows, docs, window=2048):
    """Every id in one piece, windows gapless, padding only in last windows."""
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    short = 0
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= window
        short += end < window
    of = defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
    for i, t in docs:
        x = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        end = 0
        for r in sorted(of[i], key=lambda r: r.start):
            assert r.start == end and r.doc_tokens == len(x)
            assert r.ids_crc32 == zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes())
            end += r.length
        assert end == len(x)
    return short


def test_packing_covers_every_id(documents):
    draw = random.Random(1)
    vocabulary = ["".join(draw.choices("abcdeiou", k=draw.randint(2, 9))) for _ in range(300)]
    rows = [(i, " ".join(draw.choices(vocabulary[40 * (i % 5):40 * (i % 5) + 120], k=draw.randint(1, 900))), "en", "s") for i in range(150)]
    rows += [(200, None, None, None), (201, "", "en", "s"), (202, "Ünïcode ΣΊΣΥΦΟΣ 中文 <|endoftext|>  x\x1cy", "en", "s"), (203, "z " * 9000, "en", "s")]
    df = documents(rows).repartition(3)
    got = packing.pack_documents(df, WORDS).collect()
    assert pieces_hold(got, [r[:2] for r in rows]) <= 3  # one short window per partition
    small = packing.pack_documents(df.coalesce(1), WORDS, shard_tokens=5000).collect()
    pieces_hold(small, [r[:2] for r in rows])
    assert packing.pack_documents(documents([]), WORDS).count() == 0


def test_packing_repeated_and_null_rows(documents, edge_rows):
    got = packing.pack_documents(documents(edge_rows), WORDS).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    want = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in edge_rows)
    assert sum(r.length for r in got) == want


def test_neighbours_are_the_best_unused(documents):
    """BM25 scores equal the formula, and a seed's window is filled by its topic."""
    draw = random.Random(2)
    docs = [np.array(draw.choices(range(50 * (i % 2), 50 * (i % 2) + 60), k=40)) for i in range(30)]
    index = packing.Bm25(docs)
    n, mean = len(docs), np.mean([len(d) for d in docs])
    for seed in (0, 1, 17):
        got = index.scores(seed)
        for j, d in enumerate(docs):
            want = 0.0
            for t in set(docs[seed].tolist()):
                df, tf = sum(t in x for x in docs), int((d == t).sum())
                if df > 1 and tf:
                    want += np.log1p((n - df + 0.5) / (df + 0.5)) * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(d) / mean))
            assert got[j] == pytest.approx(want)
    pieces = packing.pack_shard(np.full(30, 10), index, window=100)
    first = [d for d, _, _, seq, _ in pieces if seq == 0]
    assert first[0] == 0 and sum(d % 2 == 0 for d in first) == 10
