"""Toxicity: class-conditional Kneser-Ney models, compared per length.

Two word trigram models, toxic and ordinary.  In each class

* trigrams are counted; bigrams and words count the distinct words that precede
  them (Kneser-Ney's continuation counts), so a phrase repeated in one setting
  weighs no more than a single one;
* a discount that the counts of counts determine is taken from every count, one
  each for counts of 1, 2 and 3 or more, and its mass goes to the next shorter
  expression; at words it is pooled over both classes and shared by what each word
  gave, so rare expressions look alike in both.

A context that one class has never seen says nothing about that class, so both
back off there; a word unseen in both classes has ratio 0.  Expressions are kept
as 64-bit hashes.

Log-likelihoods (toxic minus ordinary) are compared per word at four lengths: the
best single word, the best word after the two before it, the best window of
``WINDOW`` words and the whole text.  The score is a logistic function of the
four with weights of 0 or more, so neither long nor short texts are favoured.

Labelled rows come from the rows the caller allows: at most ``fit_rows`` rows
whose texts make up at most ``fit_bytes`` bytes, taken in the order of a hash of
the id.  Both bounds are parameters, and they bound the broadcast model too.  The
logistic function is fitted on the same rows, each scored by a model that left
out its third of them (``FOLDS``).  Scoring covers every word of every text.

Defined cases: a null text or one without words scores the share of toxic
rows among the labelled ones; null labels are ignored; several labels of one id
count as toxic if one is; every row of a labelled id is learned from; without
labelled rows of both classes every score is 0.  Rows with equal ids are scored
one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WordHash, mix64, received, send, ship, stage, words

FIT_ROWS = 20_000
FIT_BYTES = 3 << 20
FOLDS = 3
WINDOW = 16
#: Largest log-likelihood ratio that a word in context counts with.
LARGEST = 6.0
COUNTS = "k3 long, c3 long, k2 long, c2 long, k1 long, fold int, toxic int, n long"
START = np.uint64(0x5BD1E9955BD1E995)


def _expressions(ws: list[bytes], memo: WordHash):
    """Hashes of each word's trigram, its context, bigram, its context, and the word."""
    w = np.fromiter(map(memo.__getitem__, ws), np.uint64, len(ws))
    v = np.concatenate(([START], w[:-1]))
    u = np.concatenate(([START], v[:-1]))
    c2 = mix64(v ^ np.uint64(2))
    c3 = mix64(mix64(u ^ np.uint64(3)) ^ v)
    return mix64(c3 ^ w), c3, mix64(c2 ^ w), c2, w


def _count(batches: Iterator) -> Iterator:
    """(text, fold, toxic) rows -> distinct trigrams of each text with their counts."""
    import pyarrow as pa
    memo = WordHash()
    for batch in batches:
        for text, fold, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ws = words(text)
            if ws:
                keys = _expressions(ws, memo)
                _, at, n = np.unique(keys[0], return_index=True, return_counts=True)
                cols = [pa.array(k[at].view(np.int64)) for k in keys]
                cols += [pa.array(np.full(len(at), x, np.int32)) for x in (fold, y)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n.astype(np.int64))],
                                                 names=["k3", "c3", "k2", "c2", "k1", "fold", "toxic", "n"])


def discounts(counts) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from the counts of counts."""
    n = [int((counts == i).sum()) for i in range(1, 5)]
    if not all(n[:2]):
        return np.array([0, 0.75, 0.75, 0.75])
    y = n[0] / (n[0] + 2 * n[1])
    return np.array([0, 1 - 2 * y * n[1] / n[0], *(
        min(max(i - (i + 1) * y * n[i] / n[i - 1], 0), i) if n[i - 1] else y for i in (2, 3))])


def _level(keys, contexts, counts):
    """One order's table: sorted keys with each class's discounted share, and
    sorted contexts with each class's backoff weight (0: context not seen)."""
    ctx, at = np.unique(contexts, return_inverse=True)
    share, back = [], []
    for c in counts:
        taken = discounts(c)[np.minimum(c, 3)]
        total = np.bincount(at, c, len(ctx))
        share.append((c - taken) / np.maximum(total, 1)[at])
        back.append(np.bincount(at, taken, len(ctx)) / np.maximum(total, 1))
        # a context all of whose counts stay whole still backs off a little
        back[-1] = np.where(total > 0, np.maximum(back[-1], 1e-3), 0)
    order = np.argsort(keys)
    return (keys[order], *(s[order].astype(np.float32) for s in share)), (ctx, *(b.astype(np.float32) for b in back))


class Model:
    """Both classes' tables, from the distinct trigrams ``(k3, c3, k2, c2, k1)``
    and their counts in ordinary and in toxic texts."""

    def __init__(self, k3, c3, k2, c2, k1, counts):
        def fewer(keys, counts, *more):
            """Distinct keys, how many rows of each class have them, and ``more`` of each."""
            kept, first, at = np.unique(keys, return_index=True, return_inverse=True)
            return kept, [np.bincount(at, c > 0, len(kept)).astype(np.int64) for c in counts], [m[first] for m in more]

        self.levels = [_level(k3, c3, counts)]
        k2, n2, (c2, w2) = fewer(k2, counts, c2, k1)
        self.levels.append(_level(k2, c2, n2))
        k1, n1, _ = fewer(w2, n2)
        (keys, *share), (_, *back) = _level(k1, np.zeros(len(k1), np.uint64), n1)
        both = sum(discounts(c)[np.minimum(c, 3)] for c in n1) + 1e-9  # k1 is sorted
        self.words = (keys, *(s + b[0] * both / both.sum() for s, b in zip(share, back, strict=True)))

    @staticmethod
    def _find(keys, wanted):
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def ratios(self, k3, c3, k2, c2, k1) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood ratio of each word by itself, and after the two before it."""
        keys, *p = self.words
        at, seen = self._find(keys, k1)
        p = [q[at] for q in p]
        alone = np.where(seen, np.log(p[1] / p[0]), 0.0)
        for ((keys, *share), (ctx, *back)), k, c in zip(self.levels[::-1], (k2, k3), (c2, c3), strict=True):
            at, known = self._find(ctx, c)
            known &= (back[0][at] > 0) & (back[1][at] > 0)
            hit = np.flatnonzero(known)
            if len(hit):
                place, found = self._find(keys, k[hit])
                for y in (0, 1):
                    p[y][hit] = np.where(found, share[y][place], 0) + back[y][at[hit]] * p[y][hit]
        return alone, np.where(seen, np.log(p[1] / p[0]), 0.0)


def features(text: str | None, model: Model, memo: WordHash) -> tuple[float, float, float, float, int]:
    """Largest ratio of a word, of a word after the two before it, of a window
    and of the text, the last two per word; number of words."""
    ws = words(text)
    if not ws:
        return 0.0, 0.0, 0.0, 0.0, 0
    alone, r = model.ratios(*_expressions(ws, memo))
    r = np.clip(r, -LARGEST, LARGEST)  # no single phrase outweighs the rest of a text
    n = len(r)
    window = np.add.reduceat(r, np.arange(0, n, WINDOW)).max() / WINDOW
    return float(alone.max()), float(r.max()), float(window), float(r.sum()) / n, n


def _logistic(x, y, ridge: float = 1e-2, steps: int = 50):
    """Weights of a ridge logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x.T * (p * (1 - p) + 1e-9)) @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def _evidence(x, y) -> list[float]:
    """Logistic weights, none below 0: a ratio never speaks against its own class
    (it would, for texts whose phrases the models know by heart)."""
    kept = list(range(x.shape[1]))
    while True:
        w = _logistic(x[:, kept], y)
        if min(w[1:], default=0.0) >= 0:
            break
        kept = [k for k, v in zip(kept, w[1:], strict=True) if v > 0]
    out = [w[0]] + [0.0] * x.shape[1]
    for k, v in zip(kept, w[1:], strict=True):
        out[k + 1] = v
    return out


def _features_udf(bc):
    @F.pandas_udf("a double, b double, c double, d double, words long")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, memo = received(bc), WordHash()
        for col in parts:
            yield pd.DataFrame([features(t, model, memo) for t in col], columns=["a", "b", "c", "d", "words"])
    return of


def _model(t: dict, use) -> Model:
    """The model of the counted rows that ``use`` marks."""
    keys, first, at = np.unique(t["k3"][use], return_index=True, return_inverse=True)
    counts = [np.bincount(at, np.where(t["toxic"][use] == y, t["n"][use], 0), len(keys)).astype(np.int64)
              for y in (0, 1)]
    return Model(keys, *(t[c][use][first] for c in ("c3", "k2", "c2", "k1")), counts)


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, key: str = "doc_id",
        text: str = "text", label: str = "toxic", fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES):
    """(broadcast model, logistic weights, share of toxic rows), or None
    without both classes.

    ``allowed`` is a condition on ``key`` that labelled rows must meet.
    """
    ship()
    sc = docs.sparkSession.sparkContext
    chosen = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & allowed)
              .groupBy(F.col(key).alias("_id")).agg((F.max(label) > 0).cast("int").alias("toxic"))
              .withColumn("_o", F.xxhash64("_id")).orderBy("_o", "_id").limit(fit_rows))
    texts = docs.select(F.col(key).alias("_id"), F.col(text).alias("_t"))
    # at most fit_rows rows of a few bytes: a bounded broadcast, then one task's running total
    size = (texts.select("_id", F.octet_length("_t").alias("size")).join(F.broadcast(chosen), "_id")
            .groupBy("_id", "toxic", "_o").agg(F.sum("size").alias("size")))
    before = Window.orderBy("_o", "_id").rowsBetween(Window.unboundedPreceding, 0)
    pick = (size.withColumn("upto", F.sum(F.coalesce("size", F.lit(0))).over(before)).where(F.col("upto") <= fit_bytes)
            .select("_id", "toxic", F.pmod(F.shiftright("_o", 8), F.lit(FOLDS)).cast("int").alias("fold")))
    pick = docs.sparkSession.createDataFrame(pick.collect(), pick.schema)  # fit_rows rows at most
    # the fitting sample is read several times: once from the documents, then from a small table
    rows = stage(texts.join(F.broadcast(pick), "_id").select("_t", "fold", "toxic").repartition(8, "_t"),
                 "toxicity-sample")
    counted = (rows.mapInArrow(_count, COUNTS).groupBy("k3", "c3", "k2", "c2", "k1", "fold", "toxic")
               .agg(F.sum("n").alias("n")).toArrow())  # as many rows as the texts have words: fit_bytes / 2 at most
    t = {c: counted.column(c).to_numpy() for c in counted.column_names}
    for c in ("k3", "c3", "k2", "c2", "k1"):
        t[c] = t[c].view(np.uint64)
    parts = [t["fold"] != f for f in range(FOLDS)]
    if any(not (use & (t["toxic"] == y)).any() for use in parts for y in (0, 1)):
        return None
    del counted
    seen = []
    for f, use in enumerate(parts):  # one fold's model at a time, in the driver and in the workers
        crossed = send(sc, _model(t, use))
        seen.append(rows.where(F.col("fold") == f).select("toxic", _features_udf(crossed)("_t").alias("f"))
                    .select("toxic", "f.*").toPandas())
        crossed.unpersist()
    whole = send(sc, _model(t, slice(None)))
    del t, parts
    seen = pd.concat(seen)
    return whole, _evidence(seen[["a", "b", "c", "d"]].to_numpy(), seen["toxic"].to_numpy()), float(seen["toxic"].mean())


def score(docs: DataFrame, fitted, key: str = "doc_id", text: str = "text",
          threshold: float = 0.3, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the ``keep`` columns, ``score`` in 0..1 and ``predicted``."""
    ship()
    base = docs.select(F.col(key), *keep, *([] if fitted is None else
                                            [_features_udf(fitted[0])(F.col(text)).alias("_f")]))
    if fitted is None:
        out = base.withColumn("score", F.lit(0.0))
    else:
        w = fitted[1]
        z = reduce(lambda z, x: z + F.col(f"_f.{x[0]}") * x[1], zip("abcd", w[1:], strict=True), F.lit(w[0]))
        out = base.withColumn("score", F.when(F.col("_f.words") == 0, F.lit(fitted[2]))
                              .otherwise(1 / (1 + F.exp(-z)))).drop("_f")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(modulus))


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             held_out: int = 2, folds: int = 4) -> DataFrame:
    """One row per document: ``key, held_out, score, predicted``; labels of
    the held-out rows (id remainder ``held_out``) are never read."""
    fitted = fit(docs, labels, remainder(key, folds) != held_out, key, text)
    mark = F.coalesce(remainder(key, folds) == held_out, F.lit(False))
    out = score(docs.select(key, text, mark.alias("_held")), fitted, key, text, keep=("_held",))
    return out.select(key, F.col("_held").alias("held_out"), "score", "predicted")
