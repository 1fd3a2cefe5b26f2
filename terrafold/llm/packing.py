"""Order-preserving packing by dynamic programming.

Documents stay in ascending doc_id order. Cuts may fall at document ends (free), after sentences
(SENTENCE), or, inside stretches without either, on a grid of GRID tokens (HARD). With dp[j] the least
cost of packing the tokens before candidate j,

    dp[j] = penalty[j] + min over i, position[j] - position[i] <= size, of dp[i] + size - (position[j] - position[i])

and the minimum of dp[i] + position[i] over a sliding window comes from a monotone queue, so the work
is linear in the candidates. A range of doc_id is one stream; its last sequence is cut into lengths
that are powers of two, which need no padding.

Defined cases: null text is empty, and its one token, the end id, is packed like any other; null
doc_ids come first, rows that repeat a doc_id are ordered by text; an empty table gives no piece;
texts of any length are handled in segments of SEGMENT tokens; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.encode import encoder
from terrafold.llm.ordering import ranges
from terrafold.llm.store import bounded

SIZE = 4096
SENTENCE, HARD, GRID = 8, 64, 64
SEGMENT = 1 << 20
#: Sequences at a segment's end that are packed again with what follows.
REDO = 4
ROWS_PER_STREAM = 1000
SUB_BATCH = 256


def best_cuts(positions: list[int], penalties: list[float], size: int) -> list[int]:
    """Positions where sequences end, least padding plus penalties. positions: ascending, from 0, gaps of at most size."""
    dp, back = [0.0] * len(positions), [0] * len(positions)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, len(positions)):
        p = positions[j]
        while positions[queue[0][1]] < p - size:
            queue.popleft()
        value, i = queue[0]
        dp[j] = penalties[j] + size - p + value
        back[j] = i
        key = dp[j] + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], len(positions) - 1
    while j:
        cuts.append(positions[j])
        j = back[j]
    return cuts[::-1]


def candidates(ids: np.ndarray, ends: np.ndarray, closes: np.ndarray) -> tuple[list[int], list[float]]:
    """Places for cuts and their penalties. ends: positions of document ends; closes[id]: the token ends a sentence."""
    n = len(ids)
    cost = np.full(n + 1, np.inf, np.float32)
    cost[np.flatnonzero(closes[ids]) + 1] = SENTENCE
    cost[ends] = 0
    cost[0] = cost[n] = 0
    at = np.flatnonzero(np.isfinite(cost))
    wide = np.flatnonzero(np.diff(at) > GRID)
    if len(wide):
        more = np.concatenate([np.arange(at[k] + GRID, at[k + 1], GRID) for k in wide])
        cost[more] = HARD
        at = np.flatnonzero(np.isfinite(cost))
    return at.tolist(), cost[at].tolist()


def binary_lengths(n: int, size: int) -> list[int]:
    """Powers of two, largest first, that add up to n."""
    out = [size] * (n // size)
    return out + [1 << k for k in range(size.bit_length() - 1, -1, -1) if n % size >> k & 1]


class Stream:
    """Packs the documents of one range as they come; yields rows of pieces."""

    def __init__(self, part: int, closes: np.ndarray, size: int) -> None:
        self.part, self.closes, self.size = part, closes, size
        self.docs: deque = deque()  # doc_id, ids, start of what is held in its document, tokens of the document
        self.held, self.sequence = 0, part << 32

    def add(self, doc_id: int | None, ids: np.ndarray):
        for at in range(0, len(ids), SEGMENT):
            part = ids[at : at + SEGMENT]
            self.docs.append((doc_id, part, at, len(ids), at + len(part) == len(ids)))
            self.held += len(part)
            if self.held >= SEGMENT:
                yield from self._emit(self._cuts()[:-REDO])

    def _cuts(self) -> list[int]:
        ids = np.concatenate([d[1] for d in self.docs])
        ends = np.cumsum([len(d[1]) for d in self.docs])[[d[4] for d in self.docs]]
        return best_cuts(*candidates(ids, ends, self.closes), self.size)

    def close(self):
        if self.held:
            cuts = self._cuts()
            before = cuts[-2] if len(cuts) > 1 else 0
            yield from self._emit(cuts[:-1] + [before + int(x) for x in np.cumsum(binary_lengths(cuts[-1] - before, self.size))])

    def _emit(self, cuts: list[int]):
        done = 0
        for cut in cuts:
            offset = 0
            while done < cut:
                doc, ids, start, n, last = self.docs.popleft()
                take = min(len(ids), cut - done)
                if take < len(ids):
                    self.docs.appendleft((doc, ids[take:], start + take, n, last))
                yield doc, start, take, zlib.crc32(np.ascontiguousarray(ids[:take])), n, self.sequence, offset
                offset += take
                done += take
            self.sequence += 1
        self.held -= done


_ROW = pa.schema([(k, pa.int64()) for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def sentence_ids(enc, end_id: int) -> np.ndarray:
    """For each id, whether its token ends with a full stop, question or exclamation mark."""
    vocab = enc.tokenizer.get_vocab()
    closes = np.zeros(max(max(vocab.values()), end_id) + 1, bool)
    for token, k in vocab.items():
        closes[k] = token.removesuffix("</w>")[-1:] in {".", "!", "?"}
    return closes


def pack(docs: DataFrame, path: str, end_id: int, size: int = SIZE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    slim = bounded(docs).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    slim = ranges(slim, "doc_id", ROWS_PER_STREAM).place(slim, "doc_id").repartition("part").sortWithinPartitions("part", "doc_id", "text")

    def pieces(batches):
        enc, stream = encoder(path), None
        closes, end = sentence_ids(enc, end_id), np.array([end_id], "<u4")

        def rows(found):
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=_ROW)

        for b in batches:
            for k in range(0, b.num_rows, SUB_BATCH):
                sub, out = b.slice(k, SUB_BATCH), []
                coded = enc.encode(sub.column("text").to_pylist())
                for p, doc, ids in zip(sub.column("part").to_pylist(), sub.column("doc_id").to_pylist(), coded, strict=True):
                    if stream is None or p != stream.part:
                        if stream is not None:
                            out += stream.close()
                        stream = Stream(p, closes, size)
                    out += stream.add(doc, np.concatenate([ids, end]))
                yield from rows(out)
        if stream is not None:
            yield from rows(list(stream.close()))

    kind = ", ".join(f"{f.name} long" for f in _ROW)
    return slim.mapInArrow(pieces, kind)
