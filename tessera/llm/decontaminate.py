"""Benchmark decontamination: size-partitioned MinHash containment search.

A document is contaminated by a test item if it contains at least
``THRESHOLD`` per cent of the item's distinct ``SHINGLE``-word shingles.  A
short item inside a long document has a tiny Jaccard similarity, so items are
searched by containment, partitioned by size:

* items are grouped by shingle count in powers of two; the upper bound of a
  partition fixes its sketch size, so every item of a partition is searched
  alike;
* an item's sketch is its ``k`` smallest shingle hashes (bottom-k MinHash).
  An item of ``n`` shingles may miss ``m = n - ceil(0.8 n)`` of them, so a
  document that holds it must hit at least ``k - m`` sketch values.  With
  ``k`` above ``m`` this never misses, unlike banding, and twice ``m`` makes
  chance hits rare;
* a document is a candidate for the items whose sketch it hits often enough.
  Only candidates are verified: their texts are read again, and their exact
  shingles, compared as text, are counted against those items.

A broadcast bit array (fixed size, ``BITS`` bits, however many items there are)
lets through the shingles whose hash may belong to a sketch, in the second
reading to a found item; only those leave the task, and are joined to the items
by hash and text.  Nothing about the documents is broadcast or collected.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; an item or
document of fewer words than a shingle has its whole word sequence as its only
shingle; items without words match nothing; rows that share a doc_id (or an
item_id) count as one document (item) with the union of their shingles; rows
with a null id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WordHash, shingle_hashes, ship, stage, words

SHINGLE = 5
THRESHOLD = 80
BITS = 1 << 26


def _shingles(n: int, filter_bc):
    """(id, text) rows -> (id, hash, shingle) rows, distinct within a text."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        bits = None if filter_bc is None else np.frombuffer(filter_bc.value, np.uint64)
        memo = WordHash()
        for batch in batches:
            src, hashes, texts = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ws = words(text)
                h = shingle_hashes(ws, n, memo)
                if bits is None:
                    at = np.arange(len(h))
                else:
                    p = h & np.uint64(BITS - 1)
                    at = np.flatnonzero((bits[(p >> np.uint64(6)).astype(np.int64)]
                                         >> (p & np.uint64(63))) & np.uint64(1))
                if not len(at):
                    continue
                k = min(n, len(ws))
                # texts decide, so shingles with one hash stay apart
                found = {(int(v), b" ".join(ws[j:j + k])) for v, j in zip(h[at].tolist(), at.tolist(), strict=True)}
                src += [i] * len(found)
                hashes += [v - (1 << 64) if v >> 63 else v for v, _ in found]
                texts += [t for _, t in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(src, pa.int64())), pa.array(hashes, pa.int64()),
                 pa.array(texts, pa.binary())], names=["_id", "h", "shingle"])
    return run


def _explode(df: DataFrame, key: str, text: str, n: int, filter_bc=None) -> DataFrame:
    src = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.col(text))
    kind = src.schema["_id"].dataType.simpleString()
    return src.mapInArrow(_shingles(n, filter_bc), f"_id {kind}, h long, shingle binary")


def _bit_array(items: DataFrame) -> bytes:
    """The items' hashes as a bit array: at most ``BITS / 64`` rows collected."""
    bits = np.zeros(BITS // 64, np.uint64)
    p = F.col("h").bitwiseAND(F.lit(BITS - 1))
    rows = (items.select(F.shiftright(p, 6).alias("w"), F.expr(f"shiftleft(1L, cast(h & 63 as int))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    bits[rows.column("w").to_numpy()] = rows.column("b").to_numpy().astype(np.int64).view(np.uint64)
    return bits.tobytes()


def sketches(items: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Item shingles with ``n``, whether in the sketch, and the hits ``need``ed."""
    from pyspark.sql import Window
    missing = lambda c: c - F.ceil(c * threshold / 100)
    sizes = items.groupBy("_id").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("upper", F.expr("shiftleft(2L, cast(floor(log2(n)) as int)) - 1"))
    sizes = sizes.withColumn("k", F.least(F.col("n"), 2 * missing(F.col("upper")) + 2))
    order = Window.partitionBy("_id").orderBy("h", "shingle")  # one item's shingles
    return (items.join(sizes, "_id").withColumn("in_sketch", F.row_number().over(order) <= F.col("k"))
            .withColumn("need", F.col("k") - missing(F.col("n"))))


def candidates(docs: DataFrame, sketch: DataFrame, key: str = "doc_id", text: str = "text",
               n: int = SHINGLE) -> DataFrame:
    """Pairs ``_doc, _item`` where the document hits ``need`` or more sketch values."""
    bc = docs.sparkSession.sparkContext.broadcast(_bit_array(sketch))
    hits = _explode(docs, key, text, n, bc).withColumnRenamed("_id", "_doc").join(sketch, ["h", "shingle"])
    return (hits.groupBy("_doc", F.col("_id").alias("_item"), "need")
            .agg(F.countDistinct("h", "shingle").alias("hit")).where("hit >= need").select("_doc", "_item"))


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", n: int = SHINGLE,
                  threshold: int = THRESHOLD) -> DataFrame:
    """One row per contaminated document and item: ``key, item_key, n_item,
    n_shared, containment``."""
    ship()
    wanted = stage(sketches(_explode(items, item_key, item_text, n).distinct(), threshold), "items")
    found = stage(candidates(docs, wanted.where("in_sketch"), key, text, n), "item-candidates")
    # verify the candidates on all shingles of their items
    exact = wanted.join(found.select(F.col("_item").alias("_id")).distinct(), "_id", "left_semi")
    bc = docs.sparkSession.sparkContext.broadcast(_bit_array(exact))
    again = docs.join(found.select(F.col("_doc").alias(key)).distinct(), key, "left_semi")
    shared = (_explode(again, key, text, n, bc).withColumnRenamed("_id", "_doc").distinct()
              .join(exact.select("h", "shingle", "n", F.col("_id").alias("_item")), ["h", "shingle"])
              .join(found, ["_doc", "_item"], "left_semi")
              .groupBy("_doc", "_item", "n").agg(F.count("*").alias("n_shared"))
              .where(F.col("n_shared") * 100 >= F.col("n") * threshold))
    return shared.select(F.col("_doc").alias(key), F.col("_item").alias(item_key), F.col("n").alias("n_item"),
                         "n_shared", (F.col("n_shared") / F.col("n")).alias("containment"))
