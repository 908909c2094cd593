"""Runs of repeated word sequences, found online by dyadic square catching.

A *run* is a stretch of consecutive words with smallest period ``q`` (words
``q`` apart are identical) of at least ``2 q`` words that no neighbouring word
extends: a maximal chain of squares.  Words are appended one by one:

* whenever an aligned block of ``2^k`` words is complete it becomes a
  **catcher** of level ``k``.  A square of period ``p`` with ``2^(k+1) - 1 <= p
  <= 2^(k+2) - 2`` has a first half of ``p`` words, which holds a whole aligned
  block of ``2^k`` words, so the block comes again ``p`` words later: level
  ``k`` catches all squares of those periods, and every period has its level;
* each appended word extends the words that end there to windows of ``2^k``
  words while such a window equals some block (a block's name is the pair of
  its halves' names), and compares the window with the two or three blocks
  whose distance fits the level.  A hit at distance ``p`` is extended to the
  left once, and *stays open*: every further word compares itself with the one
  ``p`` places before it;
* when the comparison fails the stretch is complete in both directions.  Its
  squares all share one period and have merged into one run, which is reported
  if it is long enough.

Periods that are multiples of an open one inside the same stretch are not
opened, and of stretches with the same ends the smallest period stays, so each
run appears once, with its smallest period.  A word costs a few dictionary
look-ups, at most a small number per level in repetitive text; memory is linear
in one text.

Defined cases: a null or wordless text has no words and no runs; a null id
keeps its row; repeated rows are judged row by row; a text is held whole by its
task, however long; an empty table gives no rows.  Further columns, whatever
their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship

MIN_LENGTH = 12
#: Bytes of text after which a task hands on its rows.
FLUSH_BYTES = 4 << 20


class Catchers:
    """Feed word numbers with :meth:`extend`; :meth:`finish` returns the runs."""

    def __init__(self, min_length: int = MIN_LENGTH):
        self._min = min_length
        self._words: list[int] = []
        self._open: dict[int, int] = {}                # period -> first word of its stretch
        self._found: dict[tuple[int, int], int] = {}   # (start, end) -> smallest period
        # level k has blocks of 2 ** (k + 1) words; single words need no names
        self._names: list[dict[int, int]] = []         # halves of a block -> its name
        self._blocks: list[list[int]] = []             # names of the complete blocks, in order
        self._last: list[tuple[list, list]] = []       # rings: name and end of the windows seen last

    def _close(self, p: int, end: int) -> None:
        start = self._open.pop(p)
        if end - start >= max(self._min, 2 * p):
            self._found[start, end] = min(p, self._found.get((start, end), p))

    def _catch(self, s: int, p: int) -> None:
        """The block at ``s`` came again ``p`` words later: open its stretch."""
        if any(p % q == 0 and start <= s for q, start in self._open.items()):
            return
        w = self._words
        while s and w[s - 1] == w[s - 1 + p]:
            s -= 1
        self._open[p] = s

    def extend(self, words: Iterable[int]) -> None:
        w, opened, names = self._words, self._open, self._names
        for word in words:
            i = len(w)
            w.append(word)
            if opened:
                for p in [p for p in opened if w[i - p] != word]:
                    self._close(p, i)
            if i > 1:  # blocks of one word catch the periods 1 and 2
                if w[i - 1] == word and 1 not in opened:
                    self._catch(i - 1, 1)
                if w[i - 2] == word and 2 not in opened:
                    self._catch(i - 2, 2)
                if names:
                    name = names[0].get(w[i - 1] << 32 | word)
                    if name is not None:
                        self._windows(i, name)
            elif i and w[0] == word:
                self._catch(0, 1)
            if i & 1:
                self._complete(i)

    def _windows(self, i: int, name: int) -> None:
        """The windows that end at word ``i`` and equal a block, level by level;
        ``name`` is that of the window of two words."""
        opened, size, k, levels = self._open, 2, 0, len(self._names)
        while True:
            blocks = self._blocks[k]
            for b in range(max(0, (i - 4 * size + 2) // size), (i - 3 * size + 2) // size + 1):
                if blocks[b] == name:
                    p = i + 1 - size - b * size
                    if 2 * size - 1 <= p <= 4 * size - 2 and p not in opened:
                        self._catch(b * size, p)
            ring, ends = self._last[k]
            at = i & (size - 1)
            left, end = ring[at], ends[at]
            ring[at], ends[at] = name, i
            k += 1
            if end != i - size or k == levels:
                return
            name = self._names[k].get(left << 32 | name)
            if name is None:
                return
            size *= 2

    def _complete(self, i: int) -> None:
        """Name the aligned blocks that word ``i`` completes."""
        size, k, left, right = 2, 0, self._words[i - 1], self._words[i]
        while True:
            if k == len(self._names):
                self._names.append({})
                self._blocks.append([])
                self._last.append(([0] * size, [-1] * size))
            level, blocks = self._names[k], self._blocks[k]
            blocks.append(level.setdefault(left << 32 | right, len(level)))
            size *= 2
            if (i + 1) & (size - 1):
                return
            left, right = blocks[-2], blocks[-1]
            k += 1

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of every run, by start and period."""
        for p in list(self._open):
            self._close(p, len(self._words))
        return sorted((s, e - s, p) for (s, e), p in self._found.items())


def find_runs(words: list, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of hashable words."""
    number: dict = {}
    catchers = Catchers(min_length)
    catchers.extend([number.setdefault(w, len(number)) for w in words])
    return catchers.finish()


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    out, at = [], 0
    for start, end in sorted((s + q, s + n) for s, n, q in runs):
        if start > at:
            out += words[at:start]
        at = max(at, end)
    return out + words[at:]


def _detect(min_length: int, change: Callable[[object, list], list] | None):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(rows):
            src, n, found, kept = zip(*rows, strict=True)
            flat = [r for f in found for r in f]
            ends = [0]
            for f in found:
                ends.append(ends[-1] + len(f))
            parts = [pa.array([r[j] for r in flat], pa.int64()) for j in range(3)]
            runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                            pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(src, pa.int64())), pa.array(n, pa.int64()), runs,
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            rows, held = [], 0
            ids = batch.column(0)
            for i, text in enumerate(batch.column(1)):
                words = text.as_py().encode().split() if text.is_valid else []
                if change:
                    words = change(ids[i].as_py(), words)
                found = find_runs(words, min_length)
                kept = b" ".join(collapse(words, found) if found else words)
                rows.append((i, len(words), found, kept))
                held += len(kept)
                if held > FLUSH_BYTES:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)
    return run


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                  change: Callable[[object, list], list] | None = None) -> DataFrame:
    """One row per document: ``key, n_words, runs, collapsed``.

    ``runs`` is an array of ``start, length, period`` in words, sorted by start
    and period; ``collapsed`` the text with one period of every run, its words
    joined by one space.  Words are ``[^\\x20\\x09-\\x0D]+``; ``change(id, words)``
    may replace a document's list of words (UTF-8 bytes) before it is searched.
    """
    ship()
    src = docs.select(F.col(key).alias("_id"), F.col(text))
    kind = src.schema["_id"].dataType.simpleString()
    out = src.mapInArrow(_detect(min_length, change), f"_id {kind}, n_words long, "
                         "runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.select(F.col("_id").alias(key), "n_words", "runs", "collapsed")


def plant(doc_id, words: list) -> list:
    """Make every tenth document (by the CRC-32 of its id) end in repeats of a
    stretch that its hash picks; a null id changes nothing."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def run_digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`periodic_runs` of the planted texts, as counts, the longest run
    and digests of all runs and of the collapsed text."""
    found = periodic_runs(docs, key, text, change=plant)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")),
        F.lit("\n"))), "")
    return found.withColumn("_b", best).select(
        key, F.size("runs").cast("long").alias("n_runs"), (-F.col("_b.start")).alias("start"),
        F.col("_b.length").alias("length"), (-F.col("_b.period")).alias("period"),
        F.expr("(1000 * _b.length) div (-_b.period)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
