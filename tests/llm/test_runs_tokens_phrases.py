"""Periodic runs, token counts and collocations against brute force."""
import hashlib
import random
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import periodic, phrases, tokencount

RNG = random.Random(31)
VOCAB = ["".join(RNG.choices("abcdeé", k=RNG.randint(1, 6))) for _ in range(40)]


def text(n, rng=RNG):
    return " ".join(rng.choices(VOCAB, k=n))


def brute_runs(w, least):
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i + p - s >= max(least, 2 * p):
                found.setdefault((s, i + p), p)
            i += 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=70), st.integers(1, 30), st.integers(0, 120), st.sampled_from([2, 12]))
def test_runs_equal_brute_force(w, p, tail, least):
    for seq in (w, w + (w[-p:] * 200)[:tail], (w[:p] * 200)[:tail] + w):
        assert periodic.find_runs(seq, least) == brute_runs(seq, least)


def test_runs_of_famous_words():
    f, g = [0], [0, 1]
    while len(g) < 700:
        f, g = g, g + f
    thue_morse = [bin(i).count("1") & 1 for i in range(1024)]
    for seq in (g, thue_morse, [7] * 500, [1, 2] * 300 + [1] * 50 + [2, 1] * 40):
        for least in (2, 12):
            assert periodic.find_runs(seq, least) == brute_runs(seq, least)
    assert periodic.find_runs(list(range(3000)) * 3) == [(0, 9000, 3000)]


def test_words_can_be_added_bit_by_bit():
    w = [RNG.randrange(3) for _ in range(400)]
    c = periodic.Catchers(2)
    for x in w:
        c.extend([x])
    assert c.finish() == brute_runs(w, 2)


def test_collapse():
    w = list("abcabcabcabcxyxyxyxyxyxyxy")
    runs = periodic.find_runs(w)
    assert "".join(periodic.collapse(w, runs)) == "abcxy"
    assert periodic.collapse(w, []) == w and periodic.collapse([], []) == []


DOCS = [(0, text(40)), (1, (text(5) + " ") * 9), (2, None), (3, ""), (4, " \n\t "), (5, "a" * 5000), (6, "x " * 30),
        (7, text(3000)), (8, text(30)), (8, text(30)), (None, "q w " * 20), (None, None), (9, "é\x1cü\xa0 " * 13),
        (10, text(50)), (11, "one two\x0bthree\x0cfour\rfive"), (20, text(200)), (35, text(300))]


def test_run_digest(docs_of):
    rows = DOCS + [(i, text(60)) for i in range(100, 160)]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i is not None) > 3
    expected = []
    for i, t in rows:
        w = (t or "").encode().split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        runs = brute_runs(w, 12)
        drop = {j for s, n, q in runs for j in range(s + q, s + n)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in drop)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        expected.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                         hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in periodic.run_digest(docs_of(rows)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    empty = periodic.run_digest(docs_of(rows).where("false"))
    assert empty.count() == 0 and empty.columns[:2] == ["doc_id", "n_runs"]


def test_runs_of_short_length_and_texts(docs_of):
    got = {r.doc_id: r for r in periodic.periodic_runs(docs_of([(1, "a b a b c"), (2, None)]), min_length=4).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 4, 2)] and got[1].collapsed == "a b c"
    assert got[2].runs == [] and got[2].collapsed == "" and got[2].n_words == 0


ODD = ["a", "b", "the ", "foo", " ", "  ", "\n", "\n\n", "\t", "\r\n", ".", "▁", "é", "é", "日本", "😀", "<s>", "</s>",
       "<unk>", "<0x0A>", "　", "\xa0", "\0", "\x1c", "ﬁ", "Ａ", "),\r", "​", "\x85", "1999", "//", "﻿"]


@pytest.fixture(scope="module")
def tokenizer():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokencount.model_path())


def test_pretokens_add_up(tokenizer):
    lengths = tokencount.PieceLengths(tokencount.model_path())
    assert not lengths.whole
    rng = random.Random(5)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 12))) for _ in range(8000)]
    assert lengths.counts(texts) == [len(tokenizer.encode(t)) for t in texts]


def test_cache_and_table_decide_nothing(tokenizer, monkeypatch):
    import numpy as np
    monkeypatch.setattr(tokencount, "CACHE", 5)
    monkeypatch.setattr(tokencount, "LONGEST", 3)
    top = ["abc", " ", "\n", "\nfoo"]
    plain = tokencount.PieceLengths(tokencount.model_path())
    raw = [t.encode() for t in top]
    table = b"".join(raw), np.cumsum([len(b) for b in raw]), np.array(plain.encode_all(top))
    lengths = tokencount.PieceLengths(tokencount.model_path(), table)
    for t in [text(50), "abc \nfoo  bar", "x" * 3000, text(20), "\nfoo\n", "abc"]:
        assert lengths.counts([t, None, ""]) == [len(tokenizer.encode(t)), 0, 0]


def test_token_counts(docs_of, tokenizer):
    rows = DOCS + [(50, text(9000)), (51, "word " * 4095), (52, "\n".join(text(7) for _ in range(30)))]
    got = [tuple(r) for r in tokencount.token_counts(docs_of(rows), share=1).collect()]
    n = [len(tokenizer.encode(t or "")) for _, t in rows]
    expected = [(i, len((t or "").encode()), c, c > 4096) for (i, t), c in zip(rows, n, strict=True)]
    assert sorted(got, key=str) == sorted(expected, key=str) and any(r[3] for r in got)
    assert tokencount.token_counts(docs_of(rows).where("false")).count() == 0


def brute_collocations(rows, least, first, lengths=3):
    counts, total = Counter(), Counter()
    for lang, t in rows:
        lang = lang or "und"
        t = "".join(c.lower() if c.isascii() else c for c in t or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            t = t.replace(c, "\n")
        for piece in t.split("\n"):
            w = tuple(x for x in piece.replace("\t", " ").split(" ") if x)
            total[lang] += len(w)
            for m in range(1, lengths + 1):
                for i in range(len(w) - m + 1):
                    counts[lang, w[i:i + m]] += 1
    cand = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    out = []
    for lang in total:
        ranked = []
        for (g, w), a in cand.items():
            inside = [b for (h, v), b in cand.items() if h == lang and len(v) > len(w)
                      and any(v[i:i + len(w)] == w for i in range(len(v)))]
            if g != lang or any(100 * b >= 50 * a for b in inside):
                continue
            score, _, le, ri = min((10**6 * a * a // (counts[g, w[:k]] * counts[g, w[k:]]), k, counts[g, w[:k]],
                                    counts[g, w[k:]]) for k in range(1, len(w)))
            ranked.append((-score, -a, " ".join(w).encode(), le, ri))
        for rank, (s, a, p, le, ri) in enumerate(sorted(ranked)[:first], 1):
            out.append((lang, rank, p.decode(), -a, le, ri, total[lang], -s))
    return out


@pytest.mark.parametrize("share,sample_count,lengths", [(1, 2, 3), (3, 2, 3), (50, 5, 3), (4, 2, 4)])
def test_collocations(spark, share, sample_count, lengths, monkeypatch):
    rng = random.Random(share)
    monkeypatch.setattr(phrases, "SHARE", share)
    monkeypatch.setattr(phrases, "SAMPLE_COUNT", sample_count)
    fixed = ["New York City", "ad hoc", "de\tfacto  rule", "é a\xa0b é", "the the the the"]
    rows = [(None, None), ("en", ""), ("en", " . ,"), (None, "only und words " * 12), ("xx", "a b c d e f " * 40)]
    for i in range(260):
        words = [rng.choice(fixed) if rng.random() < .15 else rng.choice(VOCAB) + rng.choice(["", "", ".", ",\n", "!"])
                 for _ in range(rng.randint(1, 25))]
        rows.append((["en", "de", "fr", None][i % 4], " ".join(words)))
    rows += [("en", "same line again and again, same line")] * 150
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("n", F.lit("x")).withColumn("m", F.lit(1))
    got = phrases.collocations(docs.repartition(5), min_count=10, first=25, lengths=lengths)
    expected = brute_collocations(rows, 10, 25, lengths)
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected) and len(expected) > 30


def test_counts_are_closed_though_the_sample_proposes_nothing(spark):
    docs = spark.createDataFrame([("en", "a b c d")] * 20, "lang string, text string")
    found = phrases.frequent_phrases(docs, sample_count=10**6).collect()
    assert {r.phrase: r.n for r in found if r.m} == dict.fromkeys(
        ["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d"], 20)
    assert [(r.lang, r.n) for r in found if not r.m] == [("en", 80)]
    assert phrases.collocations(docs.where("false")).count() == 0


@pytest.mark.parametrize("lengths,letters", [(3, 3), (7, 700)])
def test_stretches_and_long_phrases(monkeypatch, lengths, letters):
    monkeypatch.setattr(phrases, "STRETCH", 7)
    seq = " ".join(RNG.choices([f"w{i}" for i in range(letters)] + ["p"], k=900))  # 700 ** 7 passes 62 bits
    run = phrases._count(lengths, True, None, None)
    import pyarrow as pa
    got = Counter()
    for b in run(iter([pa.record_batch([pa.array(["en", "en"]), pa.array([seq, "p. q r"])], names=["l", "t"])])):
        for lang, p, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            got[lang, p] += n
    w = seq.split()
    expected = Counter({("en", ""): 903, ("en", "q r"): 1})
    expected.update(("en", x) for x in ["p", "q", "r"])
    for m in range(1, lengths + 1):
        expected.update(("en", " ".join(w[i:i + m])) for i in range(len(w) - m + 1))
    assert got == expected
