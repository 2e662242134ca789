"""Packing by lexical retrieval.

The documents of a task are taken in shards of at most ``shard_tokens``
tokens (a longer document makes a shard of its own). A shard has a BM25
inverted index over the words of its documents. A window is opened by a seed
document; the unused documents are ranked by BM25 against the seed's words,
the best that still fits is added until none fits, and the best of the rest
is cut to fill the window; its remainder opens the next one and is its seed.
So only a shard's last window can have padding.

Documents are tokenized word by word: words are cut by the tokenizer's own
pattern, and each distinct word is encoded once by the tokenizers library.
Texts with characters outside a range where its normalisation is plain
lower-casing are encoded whole by the library.

Nothing is shuffled: a shard is a stretch of one input partition, so memory
is bounded by ``shard_tokens`` and a lost task is simply run again.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 2048
SHARD_TOKENS = 1 << 20
END_ID = 1
K1, B = 1.2, 0.75
#: Bytes that the words kept per Python worker may take; they are dropped between shards when they take more.
CACHE_BYTES = 96 << 20
#: What a word takes beside its letters and ids: a string, a number, a dictionary slot, a bytes object, a list slot.
WORD_BYTES = 230
#: Characters outside ASCII and Latin letters to U+017F, within which the tokenizer's normalisation is lower-casing.
OTHER = re.compile(r"[^\t-\r\x20-\x7e\xa1-ſ]")
#: The pattern of the tokenizer file's pre-tokenizer (fixed value).
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: The same for lower-cased plain texts, their letters and numbers written out; no alternative starts like another.
_LETTERS, _NUMBERS = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾"
PLAIN_WORDS = re.compile(rf"[{_LETTERS}]+|[{_NUMBERS}]|'s|'t|'re|'ve|'m|'ll|'d|[^\s{_LETTERS}{_NUMBERS}]+")


class WordCodes:
    """Word -> number; ``code[number]`` holds its ids as 16-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        #: For words that are normalised and split already.
        self.by_word = Tokenizer.from_file(path)
        self.by_word.encode_special_tokens = True
        self.by_word.normalizer = None
        self.by_word.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        #: By id: whether a word ends with this token.
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.code: list[bytes] = []
        self.kept = 0

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, ended by ``END_ID``, and its word numbers."""
        numbers, whole, number = [], {}, self.number.__getitem__
        for i, text in enumerate(texts):
            text = text or ""
            if OTHER.search(text) is None:
                found = PLAIN_WORDS.findall(text.lower())
            else:
                whole[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids + [END_ID], "<u2")
                found = WORDS.findall(self.tokenizer.normalizer.normalize_str(text))
            numbers.append(list(map(number, found)))
        self._learn()
        end = np.array([END_ID], "<u2").tobytes()
        return [(whole[i] if i in whole else np.frombuffer(b"".join(map(self.code.__getitem__, n)) + end, "<u2"), np.array(n, np.int32))
                for i, n in enumerate(numbers)]

    def _learn(self, together: int = 512) -> None:
        """Encode the words met for the first time, many to a call, and cut after the word-end tokens.

        Where a word lacks a word-end token of its own (bytes that the
        vocabulary has not), its lot is encoded word by word.
        """
        fresh = list(islice(reversed(self.number), len(self.number) - len(self.code)))[::-1]
        lots = [fresh[i:i + together] for i in range(0, len(fresh), together)]
        self.kept += sum(map(len, fresh)) * 2 + len(fresh) * WORD_BYTES
        for lot, e in zip(lots, self.by_word.encode_batch_fast([" ".join(lot) for lot in lots], add_special_tokens=False)):
            ids = np.array(e.ids, "<u2")
            cuts = (2 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) == len(lot) and cuts[-1] == 2 * len(ids):
                data = ids.tobytes()
                self.code += [data[a:b] for a, b in zip([0, *cuts], cuts)]
            else:
                self.code += [np.array(one.ids, "<u2").tobytes() for one in self.tokenizer.encode_batch_fast(lot, add_special_tokens=False)]

    def trim(self) -> None:
        if self.kept > CACHE_BYTES:
            self.forget()


@lru_cache(maxsize=2)
def load(path: str) -> WordCodes:
    """The word table of a tokenizer file, once per Python worker."""
    return WordCodes(path)


class Bm25:
    """Inverted index of a shard: per word the documents with it and their BM25 weights."""

    def __init__(self, docs: list[np.ndarray]):
        self.n = len(docs)
        found = [np.unique(words, return_counts=True) for words in docs]
        per_doc = [len(t) for t, _ in found]
        doc = np.repeat(np.arange(self.n), per_doc)
        tf = np.concatenate([c for _, c in found]).astype(np.float64)
        _, term, df = np.unique(np.concatenate([t for t, _ in found]), return_inverse=True, return_counts=True)
        order = np.argsort(term, kind="stable")
        size = np.array([len(d) for d in docs], np.float64)
        norm = K1 * (1 - B + B * size / max(1.0, float(size.mean())))
        idf = np.log1p((self.n - df + 0.5) / (df + 0.5))
        self.doc = doc[order]
        self.weight = (idf[term] * tf * (K1 + 1) / (tf + norm[doc]))[order]
        self.stop = np.cumsum(df)
        self.start = self.stop - df
        # a document's words; one that no other document has leads nowhere
        shared = df[term] > 1
        self.of = np.split(term[shared], np.cumsum(np.bincount(doc[shared], minlength=self.n))[:-1])

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document of the shard for the words of one of them."""
        at = self.of[doc]
        if not len(at):
            return np.zeros(self.n)
        lists = [slice(a, b) for a, b in zip(self.start[at].tolist(), self.stop[at].tolist())]
        return np.bincount(np.concatenate([self.doc[s] for s in lists]),
                           np.concatenate([self.weight[s] for s in lists]), minlength=self.n)


def pack_shard(lengths: np.ndarray, index: Bm25, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, window, offset) that fill windows one after the other."""
    out, unused = [], np.ones(len(lengths), bool)
    seq = offset = 0

    def place(doc: int) -> bool:
        """Put a whole document from the present offset on; true if it opened another window."""
        nonlocal seq, offset
        start, first = 0, seq
        while start < lengths[doc]:
            take = int(min(lengths[doc] - start, window - offset))
            out.append((doc, start, take, seq, offset))
            start, offset = start + take, offset + take
            if offset == window:
                seq, offset = seq + 1, 0
        unused[doc] = False
        return seq > first

    def neighbours(seed: int) -> int | None:
        """Fill the open window; the document whose remainder opened the next, if one was cut."""
        score = np.where(unused, index.scores(seed), 0.0)
        while True:
            fit = np.where(lengths <= window - offset, score, 0.0)
            best = int(fit.argmax())
            if fit[best] <= 0:
                best = int(score.argmax())
            if score[best] <= 0:  # no unused document has a word of the seed
                return None
            score[best] = 0.0
            if place(best):
                return best if offset else None

    for first in range(len(lengths)):
        if not unused[first]:
            continue
        place(first)
        seed: int | None = first
        while seed is not None and offset:  # an open window with the seed's last tokens
            seed = neighbours(seed)
    return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer_file: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece (reads doc_id and text of ``docs``; others are ignored).

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset. A document's ids end with ``END_ID``; null and empty texts have
    that id alone. Every id lies in exactly one piece; a window's pieces
    follow each other from offset 0. Repeated rows are packed each on its
    own. ``sequence_id`` holds the partition in its upper bits. An empty
    table gives no pieces. The tokenizer file has to lie at its path on every
    executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(tokenizer_file)
        base = TaskContext.get().partitionId() << 32
        held: list[tuple[object, np.ndarray, np.ndarray]] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal base, held, tokens
            lengths = np.array([len(ids) for _, ids, _ in held])
            pieces = pack_shard(lengths, Bm25([w for _, _, w in held]), window)
            rows = [(held[d][0], start, n, zlib.crc32(held[d][1][start:start + n].astype("<u4").tobytes()), int(lengths[d]), base + seq, offset)
                    for d, start, n, seq, offset in pieces]
            base = rows[-1][5] + 1
            held, tokens = [], 0
            words.trim()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                              ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for doc_id, (ids, numbers) in zip(part.column(0).to_pylist(), words.encode(part.column(1).to_pylist())):
                    held.append((doc_id, ids, numbers))
                    tokens += len(ids)
                    if tokens >= shard_tokens:
                        yield flush()
        if held:
            yield flush()

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, SCHEMA)
