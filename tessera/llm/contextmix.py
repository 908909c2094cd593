"""Logistic context mixing over the bits of a token code (numpy core).

Tokens are coded by a binary tree: the most frequent words have leaves of
their own, the others share ``CLASSES`` leaves by their last two bytes; the
tree is a Huffman tree of the training counts.  Each bit on a token's path is
predicted in several contexts:

* the tree node alone (exact counts),
* the node with the token before, with the two before, and with the one two
  places back: hashed into tables of ``2 ** SLOT_BITS`` counters each,
* the node within this document so far: a hashed table that starts empty.

A context's counts are smoothed by the shorter context's probability, put on
the logistic scale, and combined with weights chosen by a gate: how deep the
bit is and how much the first two hashed contexts have seen.  Weights start
equal for every document and are refined online: after every ``CHUNK`` tokens
they follow the gradient of the coding cost.  Documents advance in lockstep,
each with weights of its own, so a score does not depend on its neighbours.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np

from tessera.llm.common import mix64

LEAVES, CLASSES = 8000, 250
SLOT_BITS, DOC_BITS = 20, 12
HASHED = 3
CHUNK, TOGETHER = 48, 256
#: Tokens whose bits are counted at a time: arrays that stay in a core's cache.
COUNTED = 4096
RATE, DOC_PRIOR, PRIOR = 0.01, 6.0, 3.0
#: Starting weights: node, previous token, two previous, skip, document, bias.
START = (0.25, 0.35, 0.05, 0.25, 0.55, 0.0)
DEPTHS, SEEN, BIAS = 6, 9, 0.3


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


class Tree:
    """Huffman tree over symbols 0..n-1; node and bit lists of every path."""

    def __init__(self, weights):
        n = len(weights)
        heap = [(float(w), i, i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        parent, side, nxt = {}, {}, n
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            parent[x] = parent[y] = nxt
            side[x], side[y] = 0, 1
            heapq.heappush(heap, (a + b, nxt, nxt))
            nxt += 1
        starts, nodes, bits, depth = [0], [], [], []
        for s in range(n):
            path, x = [], s
            while x in parent:
                path.append((parent[x] - n, side[x]))
                x = parent[x]
            for d, (v, b) in enumerate(reversed(path)):
                nodes.append(v)
                bits.append(b)
                depth.append(d)
            starts.append(len(nodes))
        self.start = np.array(starts, np.int64)
        self.length = np.diff(self.start)
        self.nodes, self.bits = np.array(nodes, np.int64), np.array(bits, np.int8)
        self.level = np.minimum(np.array(depth, np.int64) // 2, DEPTHS - 1)
        self.count = max(1, n - 1)
        #: counter of a node in a document's own table
        self.cell = (self.nodes * 2654435761 & 0xFFFFFFFF) >> (32 - DOC_BITS)
        #: a node's share of the hash of a table slot
        self.hash = self.nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def node_odds(self, weights):
        """(times at a node, times its bit was 1) under the symbol weights."""
        w = np.repeat(np.asarray(weights, float), self.length)
        return (np.bincount(self.nodes, w, self.count),
                np.bincount(self.nodes, w * self.bits, self.count))


def _spans(starts, lengths):
    """Concatenated ranges [start, start + length)."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def contexts(symbols, doc_start):
    """Hashes of the hashed contexts of each token: one uint64 array each.

    ``doc_start`` is each token's distance from its document's first token.
    """
    s = symbols.astype(np.uint64) + np.uint64(2)
    one, two = np.ones(len(s), np.uint64), np.ones(len(s), np.uint64)
    one[1:], two[2:] = s[:-1], s[:-2]
    one[doc_start < 1], two[doc_start < 2] = 1, 1
    k = np.uint64(1_000_003)
    return (mix64(one + (np.uint64(1) << np.uint64(40))),
            mix64(one * k + two + (np.uint64(2) << np.uint64(40))),
            mix64(two + (np.uint64(3) << np.uint64(40))))


def slots(context, length, node_hash):
    """Table slots of bits: contexts of tokens with ``length`` bits each, hashes of
    the bits' nodes."""
    h = np.repeat(context, length)
    h ^= node_hash
    h *= np.uint64(0xD6E8FEB86659FD93)
    h >>= np.uint64(64 - SLOT_BITS)
    return h.view(np.int64)


def count_bits(tree: Tree, symbols, doc_start, into) -> None:
    """Add the bits of whole documents to counters ``[HASHED][2 * slots]``."""
    ctx = contexts(symbols, doc_start)
    for lo in range(0, len(symbols), COUNTED):
        part = symbols[lo:lo + COUNTED]
        n = tree.length[part]
        at = _spans(tree.start[part], n)
        node_hash, bit = tree.hash[at], tree.bits[at]
        for k in range(HASHED):
            slot = slots(ctx[k][lo:lo + COUNTED], n, node_hash)
            slot <<= 1
            slot += bit
            np.add.at(into[k], slot, np.uint32(1))


def shrink(counts):
    """uint counters (0s, 1s) -> two 16-bit counts in a uint32, ratio kept."""
    c = counts.reshape(-1, 2).astype(np.float64)
    c *= np.minimum(1.0, 65535 / np.maximum(c.max(axis=1), 1))[:, None]
    c = np.ceil(c).astype(np.uint32)
    return c[:, 0] << np.uint32(16) | c[:, 1]


#: A bit of a path: the node's hash, probability and logit, the bit, its counter, its gate.
PATH = np.dtype([("hash", "u8"), ("p0", "f4"), ("x0", "f4"), ("zero", "f4"), ("bit", "i4"), ("cell", "i4"),
                 ("level", "i4")])


def _wide(shape, kind):
    """An array for random access; numpy asks for huge pages from 4 MB on, but not for ``zeros``."""
    return np.empty(shape, kind)


def _stretch(q):
    """Probabilities on the logistic scale; ``q`` is clipped in place."""
    np.clip(q, 1e-6, 1 - 1e-6, out=q)
    x = q / (1 - q)
    return np.log(x, out=x)


class Mixer:
    """Scores documents under a tree, node counts and hashed tables."""

    def __init__(self, tree: Tree, node_counts, tables):
        self.tree = tree
        n, ones = node_counts
        p0 = ((ones + 0.4) / (n + 0.8)).astype(np.float32)
        # what is looked up by place on a path, in one row: gathering rows of 32 bytes
        # costs about as much as gathering one column
        self.path = np.zeros(len(tree.nodes), PATH)
        for name, column in (("hash", tree.hash), ("p0", p0[tree.nodes]), ("x0", _stretch(p0.copy())[tree.nodes]),
                             ("zero", 1 - tree.bits), ("bit", tree.bits), ("cell", tree.cell),
                             ("level", tree.level * SEEN)):
            self.path[name] = column
        self.tables = _wide((len(tables), 1 << SLOT_BITS), np.uint32)
        self.tables[:] = tables
        self.own = _wide(TOGETHER << DOC_BITS, np.complex64)

    def score(self, docs: list) -> np.ndarray:
        """Natural log-probability of each document's symbols."""
        out = np.zeros(len(docs))
        order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
        for lo in range(0, len(order), TOGETHER):
            pick = order[lo:lo + TOGETHER]
            out[pick] = self._lockstep([docs[i] for i in pick])
        return out

    def _lockstep(self, docs) -> np.ndarray:
        t, total = self.tree, np.zeros(len(docs))
        sizes = np.array([len(d) for d in docs], np.int64)
        off = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        symbols = np.concatenate(docs).astype(np.int64) if sizes.sum() else np.empty(0, np.int64)
        ctx = contexts(symbols, _spans(np.zeros(len(docs), np.int64), sizes))
        gates = DEPTHS * SEEN
        # one array per input: a gather of rows costs many times more
        w = [np.full(len(docs) * gates, v, np.float32) for v in START]
        own = self.own[:len(docs) << DOC_BITS]  # (0s, 1s) of a cell, gathered at once
        own[:] = 0
        flat = own.view(np.float32)
        for at in range(0, int(sizes.max(initial=0)), CHUNK):
            alive = int(np.searchsorted(-sizes, -at, "left"))  # sizes descend
            n = np.minimum(sizes[:alive] - at, CHUNK)
            tok = _spans(off[:alive] + at, n)
            length = t.length[symbols[tok]]
            path = self.path.take(_spans(t.start[symbols[tok]], length))
            node_hash, p0, bit = path["hash"].copy(), path["p0"].copy(), path["bit"]
            owner = np.repeat(np.repeat(np.arange(alive), n), length)
            x, base, seen = [path["x0"]], p0, 0
            for k in range(HASHED):
                c = self.tables[k].take(slots(ctx[k][tok], length, node_hash))
                ones = (c & np.uint32(0xFFFF)).astype(np.float32)
                c >>= np.uint32(16)
                both = c.astype(np.float32)
                both += ones
                if k < 2:
                    seen = seen * np.int8(3) + (both >= 2) + (both >= 30)
                # the two before are smoothed by the token before, the others by the node
                ones += PRIOR * (base if k == 1 else p0)
                both += PRIOR
                ones /= both
                base = ones.copy() if k == 0 else None
                x.append(_stretch(ones))
            cell = owner << DOC_BITS
            cell += path["cell"]
            mine = own.take(cell)
            p0 *= DOC_PRIOR
            p0 += mine.imag
            zero = mine.real + mine.imag
            zero += DOC_PRIOR
            p0 /= zero
            x.append(_stretch(p0))
            gate = owner * gates
            gate += path["level"]
            gate += seen
            dot = w[-1].take(gate)
            dot *= BIAS
            for j, q in enumerate(x):
                part = w[j].take(gate)
                part *= q
                dot += part
            np.clip(dot, -20, 20, out=dot)
            np.negative(dot, out=dot)
            p = np.exp(dot, out=dot)
            p += 1
            np.divide(1, p, out=p)
            np.clip(p, 1e-6, 1 - 1e-6, out=p)
            # the probability of the bit that came
            total[:alive] += np.bincount(owner, np.log(np.abs(path["zero"] - p)), alive)
            err = (1 - path["zero"] - p).astype(np.float64)
            for j, q in enumerate(x):
                w[j][:alive * gates] += RATE * np.bincount(gate, err * q, alive * gates)
            w[-1][:alive * gates] += RATE * BIAS * np.bincount(gate, err, alive * gates)
            cell <<= 1
            cell += bit
            np.add.at(flat, cell, np.float32(1))
        return total
