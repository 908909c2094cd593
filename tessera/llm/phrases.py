"""Phrase collocations by Toivonen's sampling algorithm.

A phrase is a sequence of words inside a piece of text; within one group (a
language) it is *frequent* if it occurs ``min_count`` times or more.  Every
part of a frequent phrase is frequent, so frequent phrases can be found level by
level; instead of a pass a level:

1. a **sample** of rows is mined with a lowered threshold; its frequent words
   and phrases are the *proposal*;
2. one **full pass** counts every word, every proposed phrase and the proposal's
   *negative border*: phrases outside it whose parts (without the first, without
   the last word) all lie in it.  Counts are exact, over all rows;
3. a phrase of the border that turns out frequent is a **failure**: longer phrases
   over it were not counted.  The proposal is expanded by the failures, and a
   further pass counts only what the larger proposal adds, until a pass fails
   nowhere.  Then every frequent phrase has been counted, each in one pass.

What is sent to the tasks is the proposal as one bit array per phrase length, of
at most ``MAX_BITS`` bits: a phrase whose bit is set by another is merely counted
too.  Which passes count a phrase depends on the arrays alone, so no phrase is
counted twice.  Tasks count in bounded stretches of text with numbers for words,
and hand on one row per distinct phrase of a stretch, so that a frequent phrase
is no hot key in the shuffle on (group, phrase).

Words are ``[^\\x20\\x09]+`` in the pieces between ``[.,;:!?\\x0A-\\x0D]``, with A-Z
lowered.

Defined cases: a null text counts as empty; a null group is the group ``und``;
repeated rows each count; ids are not read; a text is counted whole, however long;
an empty table, or one without words, gives no rows.  Further columns, whatever
their names, are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WordHash, mix64, ship, stage

#: One row of so many is mined for the proposal, which takes what occurs
#: ``SAMPLE_COUNT`` times there.  Both only decide how much later passes count.
SHARE, SAMPLE_COUNT = 8, 2
#: Largest bit array sent to the tasks (32 MiB); about 16 bits a phrase below it.
MAX_BITS = 1 << 28
#: Words that a task counts together, different words it remembers, and rows it
#: hands on at once.
STRETCH, MEMO, ROWS = 1 << 20, 400_000, 1 << 14

END = b"\xff"  # ends a piece; no byte of a UTF-8 text
_CUT = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", END * 10)
COUNTED = "lang string, phrase string, n long"


def _hash(word: bytes) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(word)


def words_of(text: bytes) -> list[bytes]:
    """The words of a text, with ``END`` wherever a piece ends."""
    return text.lower().translate(_CUT).replace(END, b" \xff ").split()


def _slot(h: np.ndarray, bits: int) -> np.ndarray:
    return (h & np.uint64(bits - 1)).astype(np.int64)


class Proposal:
    """Bit arrays of proposed phrases by length; ``None`` holds every phrase."""

    def __init__(self, arrays: list[bytes] | None):
        self._arrays = None if arrays is None else [np.frombuffer(a, np.uint64) for a in arrays]

    def holds(self, m: int, h: np.ndarray) -> np.ndarray:
        if self._arrays is None:
            return np.ones(len(h), bool)
        words = self._arrays[m - 1]
        at = _slot(h, len(words) * 64)
        return ((words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def _join(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its first words and its last word."""
    return mix64(h1 ^ (h2 * np.uint64(0x9E3779B97F4A7C15)))


class _Stretch:
    """Words of one group's texts as numbers, 0 where a piece ends.

    Numbers and hashes of words are kept when a stretch is done, until a task
    holds ``MEMO`` of them.
    """

    def __init__(self, lang: str):
        self.number: dict[bytes, int] = defaultdict(lambda: len(self.number), {END: 0})
        self.seq: list[int] = []
        self._seed = np.uint64(_hash(b"\0" + lang.encode()))
        self._hashes = np.empty(0, np.uint64)

    def hashes(self) -> np.ndarray:
        done = len(self._hashes)
        new = np.fromiter(map(_hash, islice(self.number, done, None)), np.uint64, len(self.number) - done)
        self._hashes = np.concatenate([self._hashes, new ^ self._seed])
        return self._hashes

    def add(self, words: list[bytes]) -> None:
        self.seq += map(self.number.__getitem__, words)
        self.seq.append(0)


def _counted(stretch: _Stretch, lengths: int, words_too: bool, now: Proposal, before: Proposal | None):
    """(phrases, counts) of the phrases of a stretch that this pass counts; the
    empty phrase stands for all words."""
    import pyarrow as pa
    vocabulary = pa.array(stretch.number, pa.binary())
    hashes = stretch.hashes()
    seq = np.array(stretch.seq, np.int64)
    if words_too:
        n = np.bincount(seq)
        n[0] = 0
        at = np.flatnonzero(n)
        yield vocabulary.take(pa.array(at)), n[at]
        yield pa.array([b""], pa.binary()), n.sum(keepdims=True)
    # the phrase of m words that starts at each place: whether it is proposed
    # now and was before, its hash, and a code that tells phrases apart
    h, ok, v = hashes[seq], seq > 0, np.int64(len(vocabulary))
    proposed = ok & now.holds(1, hashes)[seq]
    earlier = ok & before.holds(1, hashes)[seq] if before else None
    code, dense, plain = seq, int(v), True
    for m in range(2, lengths + 1):
        last = seq[m - 1:]
        at = np.flatnonzero(proposed[:-1] & proposed[1:] & (last > 0))
        if dense * int(v) >> 62:  # codes of a text with very many words are numbered anew
            kinds, code = np.unique(code, return_inverse=True)
            dense, plain = len(kinds), False
        code = code[:-1] * v + last
        dense *= int(v)
        old = earlier[at] & earlier[at + 1] if before else None
        mine = at if old is None else at[~old]
        if len(mine):
            yield _spelt(vocabulary, seq, code, mine, m, plain)
        if m == lengths:
            return
        hm = _join(h[at], hashes[last[at]])
        h = np.zeros(len(last), np.uint64)
        h[at] = hm
        proposed = np.zeros(len(last), bool)
        proposed[at] = now.holds(m, hm)
        if before:
            earlier = np.zeros(len(last), bool)
            earlier[at] = before.holds(m, hm) & old


def _spelt(vocabulary, seq: np.ndarray, code: np.ndarray, at: np.ndarray, m: int, plain: bool):
    """The distinct phrases of ``m`` words that start at ``at``, and their counts."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if plain:  # the code is the numbers of the words
        rest, n = np.unique(code[at], return_counts=True)
        parts = []
        for _ in range(m):
            rest, w = np.divmod(rest, len(vocabulary))
            parts.insert(0, w)
    else:
        _, first, n = np.unique(code[at], return_index=True, return_counts=True)
        parts = [seq[at[first] + j] for j in range(m)]
    words = [vocabulary.take(pa.array(w)) for w in parts]
    return pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary())), n


def _count(lengths: int, words_too: bool, now_bc, before_bc):
    """(group, text) rows -> (group, phrase, count) rows of one pass."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        now = Proposal(now_bc.value if now_bc else None)
        before = Proposal(before_bc.value) if before_bc else None
        held: dict[str, _Stretch] = {}
        size = 0

        def flush():
            for lang, stretch in held.items():
                for phrase, n in _counted(stretch, lengths, words_too, now, before) if stretch.seq else ():
                    for at in range(0, len(phrase), ROWS):
                        some = phrase[at:at + ROWS].cast(pa.string())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(some), pa.string()), some,
                             pa.array(n[at:at + ROWS].astype(np.int64))], names=["lang", "phrase", "n"])
                stretch.seq.clear()
            if sum(len(s.number) for s in held.values()) > MEMO:
                held.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang, text in zip(langs, batch.column(1).cast(pa.binary()), strict=True):
                if not text.is_valid:
                    continue
                words = words_of(text.as_py())
                if lang not in held:
                    held[lang] = _Stretch(lang)
                held[lang].add(words)
                size += len(words)
                if size >= STRETCH:
                    yield from flush()
                    size = 0
        yield from flush()
    return run


def _hashes(m: int):
    """(group, phrase of m words) rows -> hashes of the phrases."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        memo = WordHash(MEMO)
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns[:2])
            seed = np.fromiter((memo[b"\0" + x.encode()] for x in langs), np.uint64, len(langs))
            words = (memo[w] for t in texts for w in t.encode().split(b" "))
            each = np.fromiter(words, np.uint64, m * len(texts)).reshape(-1, m) ^ seed[:, None]
            h = each[:, 0]
            for j in range(1, m):
                h = _join(h, each[:, j])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])
    return run


def _bits(phrases: DataFrame, m: int) -> bytes:
    """(lang, phrase of m words) rows as a bit array; at most ``MAX_BITS / 64``
    rows are collected."""
    h = stage(phrases.select("lang", "phrase").mapInArrow(_hashes(m), "h long"), "phrase-hashes")
    n = max(1, h.count())
    size = min(MAX_BITS, max(64, 1 << (16 * n - 1).bit_length()))
    at = F.col("h").bitwiseAND(F.lit(size - 1))
    rows = (h.select(F.shiftright(at, 6).alias("w"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    bits = np.zeros(size // 64, np.uint64)
    bits[rows.column("w").to_numpy()] = rows.column("b").to_numpy().astype(np.int64).view(np.uint64)
    return bits.tobytes()


def frequent_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", lengths: int = 3,
                     min_count: int = 10, share: int | None = None, sample_count: int | None = None) -> DataFrame:
    """``lang, m, phrase, n``: the exact counts of all frequent phrases of 1 to
    ``lengths`` words, and as ``m = 0`` the number of words of each group."""
    ship()
    share, sample_count = share or SHARE, sample_count or SAMPLE_COUNT
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    send = spark.sparkContext.broadcast

    def one_pass(rows, at_least, words_too, now, before, name):
        found = rows.mapInArrow(_count(lengths if now else lengths - 1, words_too, now, before), COUNTED)
        # a stretch's rows are distinct and few recur in another, so they are
        # exchanged first: combining them again in the sending task holds much and saves little
        found = found.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        found = found.where((F.col("n") >= at_least) | (F.col("phrase") == ""))
        m = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
        return stage(found.select("lang", m.alias("m"), "phrase", "n"), name)

    levels = range(1, lengths)
    sample = one_pass(src.sample(1.0 / share, seed=13), sample_count, True, None, None, "phrases-sample")
    proposal = {m: sample.where(F.col("m") == m) for m in levels}
    arrays = {m: _bits(proposal[m], m) for m in levels}
    now, before, counted = send([arrays[m] for m in levels]), None, None
    while True:
        found = one_pass(src, min_count, before is None, now, before, "phrases-pass")
        counted = found if counted is None else counted.unionByName(found)
        missed = {m: found.where(F.col("m") == m).join(proposal[m], ["lang", "phrase"], "left_anti")
                  .select("lang", "phrase") for m in levels}
        failures = {m: stage(missed[m], "phrases-failures") for m in levels}
        if all(f.isEmpty() for f in failures.values()):
            return counted
        proposal = {m: proposal[m].select("lang", "phrase").unionByName(failures[m]) for m in levels}
        grown = {m: arrays[m] if failures[m].isEmpty() else _grown(arrays[m], failures[m], m) for m in levels}
        if grown == arrays:
            return counted  # other phrases' bits had proposed the failures
        arrays = grown
        now, before = send([arrays[m] for m in levels]), now


def _grown(old: bytes, more: DataFrame, m: int) -> bytes:
    """The array with further phrases, as large as the larger of the two."""
    a, b = np.frombuffer(old, np.uint64), np.frombuffer(_bits(more, m), np.uint64)
    size = max(len(a), len(b))
    return (np.tile(a, size // len(a)) | np.tile(b, size // len(b))).tobytes()


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", lengths: int = 3, min_count: int = 10,
                 first: int = 2000, covered: int = 50) -> DataFrame:
    """The ``first`` best phrases of each group: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of two words or more with ``a`` occurrences is cut where
    ``floor(10^6 a^2 / (l r))`` is lowest, ``l`` and ``r`` being the
    occurrences of its two parts (ties: the first cut).  A phrase inside a
    longer frequent one that occurs ``covered`` per cent as often is left out.
    Arithmetic is decimal and exact.
    """
    counts = frequent_phrases(docs, lang, text, lengths, min_count)
    known = counts.where("m >= 1").select("lang", "m", "phrase", F.col("n").alias("a"))
    words = F.split("phrase", " ")
    cand = known.where("m >= 2").withColumn("_w", words)
    cuts = cand.select("lang", "phrase", "a", "_w", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k",
                       F.array_join(F.slice("_w", F.lit(1), F.col("k")), " ").alias("_left"),
                       F.array_join(F.slice("_w", F.col("k") + 1, F.size("_w")), " ").alias("_right"))
    left = known.select("lang", F.col("phrase").alias("_left"), F.col("a").alias("l"))
    right = known.select("lang", F.col("phrase").alias("_right"), F.col("a").alias("r"))
    exact = "cast(cast({} as decimal(19, 0)) * cast({} as decimal(19, 0)) as decimal(38, 0))"
    score = F.expr(f"(cast(1000000 as decimal(7, 0)) * {exact.format('a', 'a')}) div {exact.format('l', 'r')}")
    scored = cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"]).withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_b"))
    inside = cand.where("m >= 3").select("lang", "a", "m", "_w", F.explode(F.expr("sequence(2, m - 1)")).alias("_n"))
    inside = inside.select("lang", "a", "_n", "_w", F.explode(F.expr("sequence(1, m - _n + 1)")).alias("_i"))
    inside = (inside.select("lang", F.array_join(F.slice("_w", F.col("_i"), F.col("_n")), " ").alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("_longer")))
    kept = (best.join(inside, ["lang", "phrase"], "left")
            .where(F.coalesce(F.col("_longer") * 100 < F.col("a") * covered, F.lit(True))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (kept.select("lang", "phrase", "a", F.col("_b.l").alias("l"), F.col("_b.r").alias("r"),
                          F.col("_b.score").cast("long").alias("score"))
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first))
    total = counts.where("m = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a",
                                             "l", "r", "n", "score")
