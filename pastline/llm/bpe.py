"""Byte-level BPE as a monoid: encode halves, join neighbours at the boundary.

A text is cut by the tokenizer's pattern into pieces and each piece into
tokens; neither crosses a piece. Both levels are reduced as a tree.

*Tokens of a piece.* ``encode`` of a byte string longer than a leaf encodes
its halves and joins them: the last ``k`` tokens of the left half and the
first ``k`` of the right are encoded again as one window. A token sequence is
the encoding of its bytes exactly if every two neighbours, encoded together,
stay the same two tokens. Neighbours inside the halves and inside the window
do, so only the two seams of the window have to be tested; where a seam
fails, the window grows to twice the tokens on that side. When both hold, the
tokens outside are proven final.

*Pieces of a text.* The pattern looks ahead but never back, so a match
depends only on the text from its start on, up to ``LOOKAHEAD`` characters
past its end. Matches of the left half that end that far before the cut are
final. From the first one that is not, matching goes on across the cut until
a match starts where one of the right half's own matches starts; all later
ones are then final too.

Decoding concatenates the bytes of the tokens, left to right, which is the
same tree with ``+`` as its join.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

LEAF_BYTES = 8
LEAF_CHARS = 1 << 14
LOOKAHEAD = 3
#: Pieces kept encoded per Python worker; the table is emptied when it is full.
CACHE_PIECES = 1 << 20


class TreeBpe:
    """Encoder and decoder for a table of ranks (bytes -> id)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_bytes: int = LEAF_BYTES, leaf_chars: int = LEAF_CHARS):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.leaf_bytes, self.leaf_chars = leaf_bytes, leaf_chars
        self.token = {i: b for b, i in ranks.items()}
        self.pair_stays: dict[tuple[int, int], bool] = {}
        self.packed = _Packed(self)

    # -- tokens of a piece -------------------------------------------------
    def merge(self, data: bytes) -> list[int]:
        """Lowest rank first, leftmost of equals, until no pair has a rank."""
        ranks = self.ranks
        if data in ranks:
            return [ranks[data]]
        n = len(data)
        if n > 48:
            return self._merge_long(data)
        cuts = list(range(n + 1))
        pairs = [ranks.get(data[i:i + 2], 1 << 30) for i in range(n - 1)]
        while pairs:
            low = min(pairs)
            if low == 1 << 30:
                break
            i = pairs.index(low)
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(data[cuts[i]:cuts[i + 2]], 1 << 30)
            if i:
                pairs[i - 1] = ranks.get(data[cuts[i - 1]:cuts[i + 1]], 1 << 30)
        return [ranks[data[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap of pairs over a linked list: n log n."""
        ranks, n = self.ranks, len(data)
        end, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue  # one of the two has changed since
            alive[j], end[i] = 0, stop
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := prev[i]) >= 0 and (r := ranks.get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:end[i]]])
            i = end[i]
        return out

    def stays(self, a: int, b: int) -> bool:
        """Whether two tokens, encoded together, stay these two."""
        known = self.pair_stays.get((a, b))
        if known is None:
            if len(self.pair_stays) >= CACHE_PIECES:
                self.pair_stays.clear()
            known = self.pair_stays[a, b] = self.merge(self.token[a] + self.token[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of ``left`` followed by those of ``right``."""
        if not left or not right:
            return left or right
        if self.stays(left[-1], right[0]):
            return left + right
        i, j, grow_left, grow_right = len(left) - 1, 1, 1, 1
        while True:
            window = self.merge(self.decode(left[i:] + right[:j]))
            fits_left = i == 0 or self.stays(left[i - 1], window[0])
            fits_right = j == len(right) or self.stays(window[-1], right[j])
            if fits_left and fits_right:
                return left[:i] + window + right[j:]
            if not fits_left:
                i, grow_left = max(0, i - grow_left), grow_left * 2
            if not fits_right:
                j, grow_right = min(len(right), j + grow_right), grow_right * 2

    def encode_piece(self, data: bytes) -> list[int]:
        if data in self.ranks:
            return [self.ranks[data]]
        if len(data) <= self.leaf_bytes:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.encode_piece(data[:half]), self.encode_piece(data[half:]))

    # -- pieces of a text --------------------------------------------------
    def pieces(self, text: str) -> list[str]:
        if len(text) <= self.leaf_chars:
            return self.pattern.findall(text)
        ends = self._ends(text, 0, len(text))
        return [text[a:b] for a, b in zip(ends, ends[1:])]

    def _ends(self, text: str, lo: int, hi: int) -> list[int]:
        """``lo`` and the ends of the matches of ``text[lo:hi]`` taken by itself."""
        if hi - lo <= self.leaf_chars:
            return [lo, *(m.end() for m in self.pattern.finditer(text, lo, hi))]
        mid = (lo + hi) // 2
        left, right = self._ends(text, lo, mid), self._ends(text, mid, hi)
        while len(left) > 1 and left[-1] > mid - LOOKAHEAD:
            left.pop()
        k, at, stop = 0, left[-1], min(hi, mid + 64)
        while True:
            while k < len(right) and right[k] < at:
                k += 1
            if k < len(right) and right[k] == at:
                return left[:-1] + right[k:]
            m = self.pattern.match(text, at, stop)
            while stop < hi and m.end() > stop - LOOKAHEAD:  # the window has to show what follows
                stop = min(hi, stop + 2 * (stop - at))
                m = self.pattern.match(text, at, stop)
            at = m.end()
            left.append(at)

    # -- whole texts -------------------------------------------------------
    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        packed = self.packed
        if len(packed) > CACHE_PIECES:
            packed.clear()
        return b"".join(map(packed.__getitem__, self.pieces(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class _Packed(dict):
    """Piece -> its ids, packed; encodes what it does not hold."""

    def __init__(self, bpe: TreeBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        out = self[piece] = np.array(self.bpe.encode_piece(piece.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> TreeBpe:
    """The encoder of a rank file, once per Python worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return TreeBpe(ranks, pattern)


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"


def bpe_documents(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id and text; others are ignored).

    Columns: doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip (the
    decoded bytes are the text's UTF-8). Null text is empty: no tokens, and
    the hash of no bytes. Repeated rows are encoded each on its own. The rank
    file has to lie at ``rank_file`` on every executor.

    No shuffle: each task streams its rows in Arrow batches. A worker holds
    one batch and a bounded table of pieces.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(rank_file, pattern)
        for batch in batches:
            n, ids_hash, text_hash, same = [], [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                ids = bpe.encode(text)
                decoded = bpe.decode(np.frombuffer(ids, "<u4").tolist())
                n.append(len(ids) // 4)
                ids_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(hashlib.sha256(decoded).hexdigest())
                same.append(decoded == text.encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string()), pa.array(same, pa.bool_())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, SCHEMA)
