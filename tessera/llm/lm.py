"""Language-model scores: online logistic context mixing, and a unigram base.

Training gathers three things from every training document:

1. the count of every distinct token (one partial sum per task and word);
2. from these, the code tree and the known words: the ``VOCABULARY`` most
   frequent words travel to the tasks, a fixed number;
3. the bit counters of the hashed contexts: each task counts all bits of its
   documents into tables of fixed size and sends them, compressed, to be
   summed block by block.  What is sent grows with the input.

Scoring reads each document once.  Tokens with a leaf of their own cost their
path; others cost the path of their class and their share of the class.
Counts of words outside the broadcast vocabulary are joined by word, so every
token is scored by its exact count however rare it is.

A text's score is the log10 probability of its token sequence with the end
token, over the same events as the base: every training word, and the words
not seen in training as one event (here one per class).

Defined cases: a null or empty text is the end token alone; a null id is
learned from and not held out; without training documents all counts are 0;
repeated rows are scored row by row and counted as often as they occur.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import contextmix as cm
from tessera.llm.common import partitions, received, send, ship, stage

VOCABULARY = 250_000
ALPHA = 0.1
END = b""
BLOCKS = 16
#: Levels of a doubling of the count at which the vocabulary can be cut.
COUNT_LEVELS = 256
#: Words in a task's partial counts before they are sent on.
HELD_WORDS = 300_000
#: Bytes of texts split at a time, about; a longer text alone.
TEXT_BYTES = 4 << 20


def _tokens(texts, rows: int = 512) -> Iterator:
    """A column of texts in parts of at most ``rows`` texts and about ``TEXT_BYTES``:
    ``(offset, distinct words, each token's word, tokens of each text)``.

    Lower-casing, splitting (at the six ASCII white-space bytes) and telling words
    apart happen in Arrow, so Python sees a part's distinct words only.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    texts = pc.fill_null(texts, "")
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // TEXT_BYTES
    lo = 0
    while lo < len(texts):
        hi = min(lo + rows, max(lo + 1, int(np.searchsorted(size, size[lo], "right"))))
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(lo, hi - lo)))
        flat, offset = split.flatten(), split.offsets.to_numpy().astype(np.int64)
        word = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # white space at an edge leaves empty ones
        before = np.concatenate(([0], np.cumsum(word)))
        n = np.diff(before[offset - offset[0]]) + 1
        coded = flat.dictionary_encode()
        known = coded.dictionary.cast(pa.binary()).to_pylist() + [END]
        token = np.full(int(n.sum()), len(known) - 1, np.int64)
        inner = np.ones(len(token), bool)
        inner[np.cumsum(n) - 1] = False
        token[inner] = coded.indices.to_numpy(zero_copy_only=False)[word]
        yield lo, known, token, n
        lo = hi


def _count_words(batches: Iterator) -> Iterator:
    import pyarrow as pa
    total: dict = {}

    def rows():
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
        total.clear()
        return out

    for batch in batches:
        for _, known, token, _ in _tokens(batch.column(0), batch.num_rows):
            for w, n in zip(known, np.bincount(token, minlength=len(known)).tolist(), strict=True):
                if n:
                    total[w] = total.get(w, 0) + n
            if len(total) > HELD_WORDS:
                yield rows()
    yield rows()


class Code:
    """Symbols of words, the tree, and class masses; travels to the tasks."""

    def __init__(self, top: list[tuple[bytes, int]], mass: dict[int, tuple[int, int]], total: int, types: int):
        self.total, self.types, self.words = total, types, [w for w, _ in top]
        leaves = min(cm.LEAVES, len(top))
        # what is left of each class once the leaves are taken out
        n = np.array([mass.get(k, (0, 0))[0] for k in range(cm.CLASSES)], float)
        v = np.array([mass.get(k, (0, 0))[1] for k in range(cm.CLASSES)], float)
        for w, c in top[:cm.LEAVES]:
            n[cm.word_class(w)] -= c
            v[cm.word_class(w)] -= 1
        self.class_total = n + ALPHA * (v + 1)
        self.weights = [c for _, c in top[:cm.LEAVES]] + list(n + ALPHA)
        self.tree = cm.Tree(self.weights)
        # by word number, then by class for words outside the vocabulary:
        # symbol, base log-probability, log share of the class
        count = np.array([c for _, c in top], float)
        kind = np.array([cm.word_class(w) for w, _ in top], np.int64)
        self.symbol = np.concatenate((np.arange(leaves), leaves + kind[leaves:], leaves + np.arange(cm.CLASSES)))
        out = np.zeros(cm.CLASSES)
        self.base = np.concatenate((np.log10((count + ALPHA) / (total + ALPHA * (types + 1))), out))
        share = np.log10((count + ALPHA) / self.class_total[kind])
        share[:leaves] = 0
        self.share = np.concatenate((share, out))


class _Numbers(dict):
    """word -> its number in the vocabulary, or the vocabulary's size plus its
    class; numbers of other words are remembered, a bounded number of them."""

    def __init__(self, code: Code):
        super().__init__(zip(code.words, range(len(code.words)), strict=True))
        self.size = len(code.words)

    def of(self, known: list[bytes]):
        return np.fromiter(map(self.__getitem__, known), np.int64, len(known))

    def __missing__(self, word):
        s = self.size + cm.word_class(word)
        if len(self) < self.size + 200_000:
            self[word] = s
        return s


def _count_bits(code_bc):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard
        code = received(code_bc)
        numbers = _Numbers(code)
        into = [np.zeros(2 << cm.SLOT_BITS, np.uint32) for _ in range(cm.HASHED)]
        for batch in batches:
            for _, known, token, n in _tokens(batch.column(0)):
                symbols = code.symbol[numbers.of(known)][token]
                cm.count_bits(code.tree, symbols, np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n), into)
        pack = zstandard.ZstdCompressor(level=1).compress
        rows = [(k * BLOCKS + b, pack(part.tobytes())) for k in range(cm.HASHED)
                for b, part in enumerate(np.split(into[k], BLOCKS)) if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                          pa.array([r[1] for r in rows], pa.binary())], names=["block", "data"])
    return run


def _sum_blocks(batches: Iterator) -> Iterator:
    """Streams a partition's blocks into one running sum per block."""
    import pyarrow as pa
    import zstandard
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint32)
            if b in total:
                total[b] += part
            else:
                total[b] = part.astype(np.uint64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                      pa.array([cm.shrink(t).tobytes() for t in total.values()], pa.binary())],
                                     names=["block", "data"])


def _score(code_bc, tables_bc, held_out_column: int):
    names = ["doc_id", "held_out", "n_tokens", "known", "base", "score", "rare_word", "rare_n"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        code = received(code_bc)
        numbers = _Numbers(code)
        raw = tables_bc.value
        tables = [np.frombuffer(raw[k], np.uint32) for k in range(cm.HASHED)]
        mixer = cm.Mixer(code.tree, code.tree.node_odds(code.weights), tables)
        for batch in batches:
            for lo, known, token, n in _tokens(batch.column(1)):
                start, part = np.cumsum(n) - n, batch.slice(lo, len(n))
                number = numbers.of(known)
                at = number[token]
                # words outside the vocabulary, each once a text
                other = np.flatnonzero(at >= numbers.size)
                pairs, times = np.unique(np.searchsorted(start, other, "right") * len(known) + token[other],
                                         return_counts=True)
                first = np.searchsorted(pairs, np.arange(1, len(n) + 2) * len(known)).astype(np.int32)
                rare = pa.array(known, pa.binary()).take(pa.array(pairs % len(known)))
                unknown = np.add.reduceat(at >= numbers.size, start, dtype=np.int64)
                scores = (mixer.score(np.split(code.symbol[at], start[1:])) / math.log(10)
                          + np.add.reduceat(code.share[at], start))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(held_out_column), pa.array(n, pa.int64()),
                     pa.array(n - unknown, pa.int64()), pa.array(np.add.reduceat(code.base[at], start)),
                     pa.array(scores), pa.ListArray.from_arrays(pa.array(first), rare),
                     pa.ListArray.from_arrays(pa.array(first), pa.array(times, pa.int64()))], names=names)
    return run


def _class_of(word: Column) -> Column:
    """``contextmix.word_class`` on a binary column."""
    tail = F.when(F.octet_length(word) > 2, F.expr("substring(word, -2, 2)")).otherwise(word)
    return F.pmod(F.crc32(tail), F.lit(cm.CLASSES)).cast("int")


def fit(docs: DataFrame, training: Column, text: str = "text"):
    """(word counts, code, broadcast code, broadcast tables) of the training rows."""
    ship()
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.where(training).select(text)
    counts = stage(rows.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")),
                   "word-counts")
    classes = (counts.groupBy(_class_of(F.col("word")).alias("k")).agg(F.sum("n"), F.count("*")).collect())
    total, types = sum(r[1] for r in classes), sum(r[2] for r in classes)
    # the lowest level of counts that keeps the vocabulary within its size, then its words
    level = F.floor(F.log2("n") * COUNT_LEVELS)
    room, least = VOCABULARY, math.inf
    for at, many in sorted(counts.groupBy(level.alias("at")).count().collect(), reverse=True):
        if many > room:
            break
        least, room = at, room - many
    top = sorted(counts.where(level >= F.lit(float(least))).collect(), key=lambda r: (-r[1], r[0]))
    code = Code([(bytes(w), n) for w, n in top], {r[0]: (r[1], r[2]) for r in classes}, total, types)
    sent = send(sc, code)
    blocks = cm.HASHED * BLOCKS
    summed = (rows.mapInArrow(_count_bits(sent), "block int, data binary")
              .repartition(min(blocks, partitions(spark)), "block").mapInArrow(_sum_blocks, "block int, data binary"))
    size = (1 << cm.SLOT_BITS) // BLOCKS
    tables = [np.zeros(1 << cm.SLOT_BITS, np.uint32) for _ in range(cm.HASHED)]
    for b, data in summed.collect():  # tables of fixed size
        tables[b // BLOCKS][b % BLOCKS * size:(b % BLOCKS + 1) * size] = np.frombuffer(data, np.uint32)
    return counts, code, sent, sc.broadcast([t.tobytes() for t in tables])


def scores(docs: DataFrame, training: Column, held_out: Column, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row per document: ``key, held_out, n_tokens, n_known, train_tokens,
    base_score, score``."""
    counts, code, sent, tables = fit(docs, training, text)
    total, types = code.total, code.types
    src = docs.select(F.col(key).alias("_id"), F.col(text), held_out.alias("_held"))
    kind = src.schema["_id"].dataType.simpleString()
    rows = stage(src.mapInArrow(_score(sent, tables, 2), f"""doc_id {kind}, held_out boolean, n_tokens long,
        known long, base double, score double, rare_word array<binary>, rare_n array<long>""")
                 .withColumn("_row", F.monotonically_increasing_id()), "lm-rows")
    # words outside the vocabulary: their exact counts, joined by word
    rare = (rows.select("_row", F.explode(F.arrays_zip("rare_word", "rare_n")).alias("r"))
            .select("_row", F.col("r.rare_word").alias("word"), F.col("r.rare_n").alias("times"))
            .join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0))))
    share = F.create_map(*[F.lit(x) for k, t in enumerate(code.class_total) for x in (k, float(t))])
    z = total + ALPHA * (types + 1)
    rare = rare.withColumn("_t", share[_class_of(F.col("word"))]).groupBy("_row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * F.log10((F.col("n") + ALPHA) / F.lit(z))).alias("b"),
        F.sum(F.col("times") * F.log10((F.col("n") + ALPHA) / F.col("_t"))).alias("s"))
    out = rows.drop("rare_word", "rare_n").join(rare, "_row", "left")
    return out.select(
        F.col("doc_id").alias(key), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("s", F.lit(0.0))).alias("score"))
