"""Best-fit packing of documents into token sequences, planned on a histogram.

1. Every document is tokenised where it is read, closed with id 0, and cut
   into pieces if it is longer than a sequence: the first piece takes the
   remainder, all others are full.  One row per piece is staged, carrying
   its rank among the pieces of its length *in its task*.
2. The plan needs only how many pieces each length has: at most ``capacity``
   counts.  Best-fit decreasing runs over counts: identical sequences are
   handled as one group, so its steps depend on ``capacity``, not on the
   number of documents.  The plan is a list of segments *(length, first
   rank, count, first sequence, offset)*.
3. Each piece joins its slot on its rank within its length: task-level rank
   plus the count of that length in earlier tasks (a join on task and
   length), then a range lookup in the segments.  No window holds all
   pieces of a length, so a length shared by a third of all pieces is no
   hot group.

Defined cases: a null or empty text is the single id 0 (one piece); rows
with equal or null ids are packed as separate documents; an empty table
gives no rows.  Sequence numbers are gapless from 0.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ship, stage

CAPACITY = 2048
#: Chunks kept per task; the cache is emptied when full, so memory is bounded.
CACHE_CHUNKS = 600_000
PIECES = ("piece int, start long, length long, ids_crc32 long, ids binary, task long, rank long")
_RUNS = re.compile(r"\s\s(?:\s|\Z)")


def ranks_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens() -> dict[str, int]:
    """Added tokens of ``byte_bpe_50k.json``, which are matched in texts as they stand."""
    import json

    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
        raise ValueError("added tokens that depend on their surroundings")
    return {a["content"]: a["id"] for a in added}


class Tokens(dict):
    """Text -> token ids as little-endian uint32 bytes.

    The byte-pair rank file holds the vocabulary of ``byte_bpe_50k.json``;
    ids are the same as the ``tokenizers`` library's for that file, tested
    on whole texts.  Texts are first split at the ``added`` tokens; without
    them these are read as ordinary text.  What lies between is cut before single spaces, where the
    pre-tokeniser always cuts too, and the chunks remembered.  Runs of white
    space that its look-ahead could join across a cut go through whole.
    """

    def __init__(self, path: str, added: dict[str, int] | None = None):
        super().__init__()
        self._added = {t: np.array([i], "<u4").tobytes() for t, i in (added or {}).items()}
        longest = sorted(self._added, key=len, reverse=True)
        self._split = re.compile(f"({'|'.join(map(re.escape, longest))})").split if longest else None
        import base64

        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _pack(self, text: str) -> bytes:
        return np.array(self._encode(text), "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        out = self[chunk] = self._pack(chunk)
        return out

    def ids(self, text: str) -> bytes:
        if self._split is None:
            return self._ordinary(text)
        return b"".join(self._added.get(part) or self._ordinary(part) for part in self._split(text))

    def _ordinary(self, text: str) -> bytes:
        if not text:
            return b""
        if _RUNS.search(text):
            return self._pack(text)
        first, *rest = text.split(" ")
        head = self._pack(first) if first else b""
        return head + b"".join(map(self.__getitem__, [" " + w for w in rest]))


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be short."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(path: str, added: dict[str, int], capacity: int, keep_ids: bool):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        tokens, seen, task = Tokens(path, added), {}, TaskContext.get().partitionId()
        for batch in batches:
            key = batch.column(0)
            src, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = tokens.ids(text or "") + b"\0\0\0\0"
                for p, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + length)]
                    rank = seen.get(length, 0)
                    seen[length] = rank + 1
                    src.append(i)
                    rows.append((p, start, length, zlib.crc32(part),
                                 part if keep_ids else None, task, rank))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [key.take(pa.array(src, pa.int64()))]
                + [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "task", "rank"])
    return run


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    ``histogram`` maps a length to its number of pieces.  Returns segments
    ``(length, rank0, count, seq0, offset)``: pieces of that length with rank
    ``rank0 + i`` go to sequence ``seq0 + i`` at ``offset``.  A piece goes to
    the open sequence with the least room that still holds it, else to a
    new one.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs of sequences
    sizes: list[int] = []                        # free sizes in use, ascending
    segments, opened = [], 0

    def put(free: int, seq: int, n: int) -> None:
        if free and n:
            if free not in room:
                room[free] = []
                insort(sizes, free)
            room[free].append((seq, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                free = sizes[at]
                seq, n = room[free].pop()
                if not room[free]:
                    del room[free], sizes[at]
            else:
                free, seq = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            deep = free // length        # best fit fills one sequence first
            used = min(n, -(-left // deep))
            put(free, seq + used, n - used)
            take = min(left, used * deep)
            full, rest = divmod(take, deep)
            for layer in range(deep if full else rest):
                count = full + (layer < rest)
                segments.append((length, rank, count, seq, capacity - free + layer * length))
                rank += count
            put(free - deep * length, seq, full)
            if rest:
                put(free - rest * length, seq + full, 1)
            left -= take
    return segments


def _slot(segments, length: Column, rank: Column) -> Column:
    """Range lookup of (length, rank) in the segments, in the tasks."""
    seg = np.array(segments or [(0, 0, 0, 0, 0)], np.int64)
    seg = seg[np.lexsort((seg[:, 1], seg[:, 0]))]
    span = int(seg[:, 1].max() + seg[:, 2].max() + 1)
    starts = seg[:, 0] * span + seg[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        s = seg[np.searchsorted(starts, n * span + r, "right") - 1]
        return pd.DataFrame({"sequence_id": s[:, 3] + r - s[:, 1], "offset": s[:, 4]})
    return slot(length, rank)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         ranks: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``key, piece, start, length, ids_crc32, sequence_id,
    offset`` and, with ``keep_ids``, ``ids`` (little-endian uint32 bytes)."""
    ship()
    src = docs.select(F.col(key).alias("doc_id"), F.col(text))
    id_type = src.schema["doc_id"].dataType.simpleString()
    added = {} if ranks else added_tokens()
    pieces = stage(src.mapInArrow(_pieces(ranks or ranks_path(), added, capacity, keep_ids),
                                  f"doc_id {id_type}, {PIECES}"), "pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = stage(per_task.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "ranks")
    histogram = dict(base.groupBy("length").agg(F.sum("n")).collect())  # at most ``capacity`` rows
    segments = plan(histogram, capacity)
    out = pieces.join(base.select("task", "length", "base"), ["task", "length"]).withColumn(
        "_slot", _slot(segments, F.col("length"), F.col("base") + F.col("rank")))
    return out.select(F.col("doc_id").alias(key), "piece", "start", "length", "ids_crc32",
                      "_slot.sequence_id", "_slot.offset", *(["ids"] if keep_ids else []))
