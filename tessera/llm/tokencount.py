"""Token counts of whole texts by a two-tier lookup on the map side.

The tokens of a text are the sum over its *pre-tokens*: stretches between which
no merge of the vocabulary can reach.  Most of them come from a small set, so
the length (number of tokens) of a pre-token is looked up, and the tokenizer
only runs on misses:

1. **frequent table**: every task of a first pass counts the pre-tokens of its
   rows in a bounded summary and hands on its ``TOP`` most frequent; the
   ``TABLE`` most frequent of all are encoded and broadcast as one compact
   block (UTF-8 bytes, offsets, lengths), whose size is bounded by
   ``TABLE`` pre-tokens of ``LONGEST`` characters whatever the corpus;
2. **worker cache**: the misses of a stretch of texts are encoded together, as
   lines of one text, and remembered by the task; its cache is emptied when it
   holds ``CACHE`` entries.

Pre-tokens never leave the task that reads them (only the bounded summaries
do), so nothing is shuffled by pre-token, and a popular one costs nothing.
Neither tier decides a result: both hold lengths the tokenizer itself gave.

Pre-tokens of a sentence-piece model are words with the spaces before them, cut
at line feeds: no piece holds a line feed, or a space behind another character.
:class:`PieceLengths` checks both when it opens the model, and that the model
normalises nothing but spaces; a model that breaks one of them is applied to
whole texts.

Defined cases: a null text counts as empty (no bytes, no tokens); a repeated
id keeps one row per input row; very long texts and pre-tokens are encoded
whole (pre-tokens over ``LONGEST`` characters are not remembered); an empty table
gives no rows.  Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship

#: Entries of the broadcast table, and pre-tokens a task may propose for it.
TABLE, TOP = 1 << 17, 1 << 14
#: Different pre-tokens a task counts before it drops the rare half.
COUNTED = 1 << 18
#: Entries of a worker's cache of misses.
CACHE = 400_000
#: Characters of the longest pre-token that either tier holds.
LONGEST = 64
#: Characters of text whose misses are encoded together.
CHUNK = 1 << 20

MARK = "▁"  # what a space becomes
_PARTS = re.compile(r" *[^ ]+| +")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text, as keys.

    A key that starts with a line feed is that feed and what follows it; one
    that starts with a space stands for itself; any other is a word with the
    one space before it (a text's first word has one, too: the tokenizer's).
    """
    if not text:
        return []
    text = text.replace(MARK, " ")
    cut = text.replace("\n", " \n")
    if cut[0] != " " and cut[-1] != " " and "  " not in cut:
        return cut.split(" ")
    keys: list[str] = []
    for i, line in enumerate((" " + text).split("\n")):
        parts = _PARTS.findall(line)
        if i:
            keys.append("\n" + parts.pop(0) if parts and parts[0][0] != " " else "\n")
        keys += [p[1:] if p[:2].strip(" ") else p for p in parts]
    return keys


class PieceLengths:
    """Token counts of texts by a sentence-piece model: the frequent table, then
    the worker's cache on top of it, then the tokenizer."""

    def __init__(self, path: str, frequent: tuple[bytes, np.ndarray, np.ndarray] | None = None):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self._encode = model.encode
        self._feed = model.piece_to_id("<0x0A>")
        self.whole = not _splits(model)
        self._table: dict[str, int] = {}
        if frequent:
            blob, ends, lengths = frequent
            start = 0
            for end, n in zip(ends.tolist(), lengths.tolist(), strict=True):
                self._table[blob[start:end].decode()] = n
                start = end
        self._known = dict(self._table)

    def encode_all(self, keys: list[str]) -> list[int]:
        """Token counts of pre-tokens, which are encoded as lines of a text."""
        out: list[int] = []
        for at in range(0, len(keys), 4096):
            some = keys[at:at + 4096]
            lines = "".join(k if k[0] == "\n" else "\n" + k if k[0] == " " else "\n " + k for k in some)
            ids = np.array(self._encode(lines), np.int32)
            feeds = np.append(np.flatnonzero(ids == self._feed), len(ids))
            own = np.fromiter((k[0] == "\n" for k in some), bool, len(some))
            out += (np.diff(feeds) - 1 + own).tolist()
        return out

    def counts(self, texts: list[str | None]) -> list[int]:
        if self.whole:
            return [len(self._encode(t)) if t else 0 for t in texts]
        split = [pretokens(t) for t in texts]
        missed = list(set().union(*split).difference(self._known))
        if len(self._known) + len(missed) > len(self._table) + CACHE:
            self._known = dict(self._table)
            missed = list(set().union(*split).difference(self._known))
        known = self._known
        known.update(zip(missed, self.encode_all(missed), strict=True))
        out = [sum(map(known.__getitem__, keys)) for keys in split]
        for key in missed:
            if len(key) > LONGEST:
                del known[key]
        return out


def _splits(model) -> bool:
    """Whether a text's tokens are the sum over its pre-tokens."""
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any("\n" in p or MARK in p.lstrip(MARK) for p in pieces):
        return False
    probe = " x   \u3000ﬁＡé \t\n y "
    return (model.normalize(probe) == MARK + probe.replace(" ", MARK)
            and model.encode("\n")[-1] == model.piece_to_id("<0x0A>"))


def _chunks(texts: list) -> Iterator[list]:
    """Slices of about ``CHUNK`` characters; a longer text is one of its own."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK:
            yield texts[at:i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield texts[at:]


def _summaries():
    """Text rows -> the task's most frequent pre-tokens with counts (lossy, bounded)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(pretokens(text))
                if len(counts) > COUNTED:
                    counts = Counter(dict(counts.most_common(COUNTED // 2)))
        top = [(p, n) for p, n in counts.most_common(TOP) if n > 1 and len(p) <= LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()),
                                          pa.array([n for _, n in top], pa.int64())], names=["pre", "n"])
    return run


def frequent_table(texts: DataFrame, path: str, size: int = TABLE) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The ``size`` most frequent pre-tokens: (bytes, end offsets, token counts)."""
    top = (texts.mapInArrow(_summaries(), "pre string, n long").groupBy("pre").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "pre").limit(size).select("pre").toArrow().column("pre").to_pylist())
    lengths = PieceLengths(path)
    raw = [p.encode() for p in top]
    return (b"".join(raw), np.cumsum([len(b) for b in raw], dtype=np.int64),
            np.array(lengths.encode_all(top), np.int32))


def _count(path: str, table_bc):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        lengths = PieceLengths(path, table_bc.value)
        for batch in batches:
            text = batch.column(1)
            n = [c for some in _chunks(text.to_pylist()) for c in lengths.counts(some)]
            size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n, pa.int64())],
                                             names=["_id", "n_bytes", "n_tokens"])
    return run


#: One row of so many is read by the pass that proposes frequent pre-tokens.
SHARE = 16


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 4096,
                 path: str | None = None, share: int = SHARE) -> DataFrame:
    """One row per document: ``key, n_bytes, n_tokens, over_limit``.

    ``path`` is a sentence-piece model.  The frequent table is proposed by one
    row in ``share``; it saves encodings and decides no count.
    """
    ship()
    path = path or model_path()
    src = docs.select(F.col(key).alias("_id"), F.col(text))
    kind = src.schema["_id"].dataType.simpleString()
    table = frequent_table(src.select(text).sample(1.0 / share, seed=11), path)
    bc = docs.sparkSession.sparkContext.broadcast(table)
    out = src.mapInArrow(_count(path, bc), f"_id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("_id").alias(key), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
