"""Each operator against brute force on small tables with the awkward cases:
nulls, empty texts, ties, repeated rows, clashing columns, empty tables."""
import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import (ann, decontaminate, html, lm, neardup, packing, sharding, substrings, toxicity, urls)
from tessera.llm.common import words

RNG = random.Random(11)
VOCAB = ["".join(RNG.choices("abcdeé", k=RNG.randint(2, 6))) for _ in range(300)]


def text(n, rng=RNG):
    return " ".join(rng.choices(VOCAB, k=n))


BASE = text(60)
LONG = text(120)
NEAR = " ".join(w if i != 30 else "changed" for i, w in enumerate(BASE.split()))
CORPUS = [(0, BASE), (1, BASE), (2, NEAR), (3, None), (4, ""), (5, " \n"), (6, "one"), (7, "ONE"), (8, LONG),
          (9, text(20) + " " + LONG[:300] + " " + text(20)), (None, BASE), (10, text(2500)), (11, "aaaa" * 60),
          (12, "xx" + "aaaa" * 60), (8, LONG), (13, "é" * 70), (14, "-é" + "é" * 60)]


def shingles(t, n):
    ws = words(t)
    return {tuple(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set()


def test_near_duplicates(docs_of):
    rng = random.Random(4)
    rows = list(CORPUS)
    for g in range(3):  # groups of edited copies around the threshold, some linked only in a chain
        seed = [rng.choice(VOCAB) for _ in range(50)]
        for k in range(14):
            cur = list(seed)
            for _ in range(rng.randint(0, 9)):
                cur[rng.randrange(len(cur))] = rng.choice(VOCAB)
            rows.append((100 + 20 * g + k, " ".join(cur)))
            if k % 4 == 3:
                seed = cur
    for n in (2, 5):
        sets = [(i, shingles(t, n)) for i, t in rows]
        comp = {i: i for i, _ in rows if i is not None}
        changed = True
        named = [(i, s) for i, s in sets if i is not None and s]
        links = [(a, b) for a, s in named for b, t in named
                 if a < b and 100 * len(s & t) >= 80 * len(s | t)]
        while changed:
            changed = False
            for a, b in links:
                m = min(comp[a], comp[b])
                changed |= comp[a] != m or comp[b] != m
                comp[a] = comp[b] = m
        got = neardup.near_duplicates(docs_of(rows), n=n).collect()
        want = Counter((i, len(s), comp.get(i), comp.get(i) == i if i is not None else True) for i, s in sets)
        assert Counter(tuple(r) for r in got) == want


def brute_removed(rows):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            if i is not None:
                first[b[k:k + 50]] = min(i, first.get(b[k:k + 50], i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if i is not None and first[b[k:k + 50]] < i:
                gone[k:k + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("many,buffer,flush", [(2000, 1 << 20, 1_500_000), (0, 400, 50)])
def test_substring_dedup(docs_of, monkeypatch, many, buffer, flush):
    monkeypatch.setattr(substrings, "MANY", many)
    monkeypatch.setattr(substrings, "BUFFER", buffer)
    monkeypatch.setattr(substrings, "FLUSH", flush)
    rng = random.Random(9)
    rows = list(CORPUS)
    passage = text(25, rng)
    for i in range(20, 50):  # a passage at different places, with different neighbours
        rows.append((i, text(rng.randint(0, 15), rng) + " " + passage[rng.randint(0, 20):] + text(rng.randint(0, 15), rng)))
    got = substrings.dedup_digest(docs_of(rows)).collect()
    assert Counter(tuple(r) for r in got) == brute_removed(rows)


def test_shard_over_two_mebibytes():
    rng = np.random.default_rng(17)
    noise = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    snippets = [noise(70) for _ in range(50_000)]
    assert 3 << 20 < 50_000 * 70 < substrings.SHARD
    for a, b in ((5, 9), (20_000, 49_000), (31_000, 40_000), (45_000, 49_999), (49_990, 7)):  # past 2 MiB: from 29,960
        shared = noise(58)
        snippets[a], snippets[b] = shared + noise(12), noise(12) + shared
    first = {}
    for doc, t in enumerate(snippets):
        for k in range(21):
            first.setdefault(t[k:k + 50], doc)
    want = {(doc, k) for doc, t in enumerate(snippets) for k in range(21) if first[t[k:k + 50]] < doc}
    rows = [(0, substrings.SNIPPETS, doc, None, struct.pack("<IiIB", 1, doc, 0, 21) + t)
            for doc, t in enumerate(snippets)]
    got = set()
    for batch in substrings._sort_shards(1)(iter([substrings._batch(rows)])):
        for r in batch.to_pylist():
            for a, b in np.frombuffer(r["data"], "<u4").reshape(-1, 2).tolist():
                got |= {(r["doc"], k) for k in range(a, b - 49)}
    assert got == want and len(want) == 45


def test_batches_are_bounded_in_bytes(spark):
    from tessera.llm.common import ship

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])
    ship()
    rows = spark.range(0, 60, 1, 1).selectExpr("cast(repeat('x', 300000) as binary) as d").repartition(1)
    got = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(got) > 60 * 300_000 and max(got) < 5 << 20  # one batch of 18 MB before


def test_dedup_texts_keeps_rows_and_columns(docs_of):
    df = docs_of(CORPUS)
    out = substrings.dedup_texts(df)
    assert out.columns == df.columns and out.count() == len(CORPUS)
    by = {}
    for r in out.collect():
        by.setdefault(r.doc_id, []).append(r.text)
    assert by[0] == [BASE] and by[1] == [""] and by[3] == [None] and by[None] == [BASE] and by[8] == [LONG, LONG]
    assert all(r.n == "x" for r in out.collect())


def test_contamination(docs_of, spark):
    item, other = (" ".join(RNG.sample(VOCAB, k)) for k in (12, 30))
    edited = other.split()
    edited[3] = "zz"  # 4 of 26 shingles lost
    twice = other.split()
    twice[3] = twice[20] = "zz"
    rows = CORPUS + [(200, text(400) + " " + item.encode().upper().decode() + " " + text(400)), (201, " ".join(edited)),
                     (202, " ".join(twice)), (203, "a b"), (None, item)]
    items = [(1, item), (2, other), (3, "A  b"), (4, None), (5, ""), (None, item), (6, item), (7, text(40))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(1)).withColumn("h", F.lit(2))
    want = set()
    for d, t in rows:
        for i, u in items:
            s = shingles(u, 5)
            k = len(s & shingles(t, 5))
            if d is not None and i is not None and s and k * 100 >= len(s) * 80:
                want.add((d, i, len(s), k, k / len(s)))
    got = decontaminate.contamination(docs_of(rows), bench).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) >= 4


def test_only_candidates_of_the_sketches_are_verified(docs_of, spark, monkeypatch):
    item = " ".join(RNG.sample(VOCAB, 60))
    ws = item.split()
    rows = [(1, text(50) + " " + item + " " + text(50)), (2, " ".join(ws[:20])), (3, " ".join(ws[30:]))]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    find, seen = decontaminate.candidates, []

    def spy(*a, **k):
        out = find(*a, **k)
        seen.extend(out.collect())
        return out

    monkeypatch.setattr(decontaminate, "candidates", spy)
    assert [r.doc_id for r in decontaminate.contamination(docs_of(rows), bench).collect()] == [1]
    assert [tuple(r) for r in seen] == [(1, 1)]
    monkeypatch.setattr(decontaminate, "candidates", lambda *a, **k: find(*a, **k).limit(0))
    assert decontaminate.contamination(docs_of(rows), bench).count() == 0


def test_broadcast_objects_need_no_installed_package():
    import subprocess
    import sys
    from pyspark import cloudpickle
    from tessera.llm import common
    common.ship()
    total = {c: np.array([1, 2], np.uint64) for c in ("k3", "c3", "k2", "c2", "k1")} | {
        "toxic": np.array([0, 1]), "n": np.array([1, 1])}
    held = cloudpickle.dumps([urls.Trie([("block", "a.b", "/c")]), lm.Code([(b"x", 2)], {}, 2, 1),
                              toxicity._model(total, np.ones(2, bool))])
    code = "import pickle, sys; t, c, m = pickle.load(sys.stdin.buffer); print(t.find('x.a.b', '/cd')[3], c.total)"
    out = subprocess.run([sys.executable, "-I", "-c", code], input=held, capture_output=True, cwd="/", check=False)
    assert out.stdout.split() == [b"block", b"2"], out.stderr.decode()[-500:]


def test_language_model(docs_of, monkeypatch):
    monkeypatch.setattr(lm, "VOCABULARY", 40)
    train = F.coalesce(toxicity.remainder("doc_id", 10) != 0, F.lit(True))
    held = F.coalesce(toxicity.remainder("doc_id", 10) == 0, F.lit(False))
    rows = CORPUS + [(300 + i, text(30)) for i in range(40)]
    got = lm.scores(docs_of(rows), train, held).collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    count = Counter(w for i, t in rows if not out(i) for w in words(t) + [b""])
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t in rows:
        ws = words(t) + [b""]
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        want[(i, out(i), len(ws), sum(w in count for w in ws), n, round(base, 6))] += 1
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    long_ = [r for r in got if r.n_tokens > 20]
    assert sum(r.score for r in long_) > sum(r.base_score for r in long_)


def test_toxicity(docs_of, spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(2500):
        ws = rng.choices(VOCAB, k=rng.randint(5, 60))
        bad = i % 5 == 0
        if bad:
            for _ in range(2):
                ws.insert(rng.randrange(len(ws)), rng.choice(["vile", "vilest", "grim,"]))
        rows.append((i, " ".join(ws)))
        labels.append((i, int(bad)))
    rows += [(3000, None), (3001, ""), (None, "vile vilest grim, vile"), (3002, "vile " * 5000)]
    lab = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs_of(rows), lab).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    by = {r.doc_id: r for r in got}
    assert by[None].predicted == 1 and by[3002].predicted == 1 and by[3001].score == by[3000].score < 0.3
    # labels of the held-out rows change nothing
    flipped = lab.withColumn("toxic", F.when(toxicity.remainder("doc_id", 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs_of(rows), flipped).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in got)
    none = toxicity.toxicity(docs_of(rows[:5]), lab.where("toxic = 0")).collect()
    assert all(r.score == 0 for r in none)


def plain_ratios(texts, asked):
    """Class-conditional Kneser-Ney by the book: dicts of word tuples, one class and one word at a time."""
    def estimated(counts):
        n = [sum(c == i for c in counts) for i in range(1, 5)]
        if not n[0] or not n[1]:
            return [0, .75, .75, .75]
        y = n[0] / (n[0] + 2 * n[1])
        return [0, 1 - 2 * y * n[1] / n[0]] + [
            min(max(i - (i + 1) * y * n[i] / n[i - 1], 0), i) if n[i - 1] else y for i in (2, 3)]

    tables = []
    for y in (0, 1):
        tri = Counter()
        for t, toxic in texts:
            ws = ["<s>", "<s>", *t.split()]
            if toxic == y:
                tri.update(zip(ws, ws[1:], ws[2:]))
        bi = Counter(g[1:] for g in tri)
        tables.append([tri, bi, Counter(g[1:] for g in bi)])
    cut = [[estimated(t.values()) for t in of] for of in tables]
    given = Counter()
    for of, d in zip(tables, cut):
        for w, c in of[2].items():
            given[w] += d[2][min(c, 3)]

    def parts(y, order, gram):
        t, d = tables[y][order], cut[y][order]
        row = {g: c for g, c in t.items() if g[:-1] == gram[:-1]}
        total = sum(row.values())
        c = row.get(gram, 0)
        return total and ((c - d[min(c, 3)]) / total, max(sum(d[min(x, 3)] for x in row.values()) / total, 1e-3))

    out = []
    for t in asked:
        ws = ["<s>", "<s>", *t.split()]
        for g in zip(ws, ws[1:], ws[2:]):
            if g[2:] not in given:
                out.append((0.0, 0.0))
                continue
            own = [parts(y, 2, g[2:]) for y in (0, 1)]
            p = [s + b * given[g[2:]] / sum(given.values()) for s, b in own]
            alone = math.log(p[1] / p[0])
            for order in (1, 0):
                own = [parts(y, order, g[order:]) for y in (0, 1)]
                if all(own):
                    p = [s + b * q for (s, b), q in zip(own, p)]
            out.append((alone, math.log(p[1] / p[0])))
    return out


def test_toxicity_models_equal_plain_kneser_ney():
    from tessera.llm.common import WordHash
    rng, memo = random.Random(8), WordHash()
    few = VOCAB[:25]
    texts = [(" ".join(rng.choices(few, k=rng.randint(1, 30))), int(i % 4 == 0)) for i in range(60)]
    texts += [texts[0]] * 3
    rows = [r for t, y in texts for r in next(iter([list(zip(*toxicity._expressions(words(t), memo)))]))
            for r in [(*r, y)]]
    total = Counter(rows)
    t = {c: np.array([r[i] for r in total], np.uint64) for i, c in enumerate(("k3", "c3", "k2", "c2", "k1"))}
    t |= {"toxic": np.array([r[5] for r in total]), "n": np.array(list(total.values()))}
    model = toxicity._model(t, np.ones(len(total), bool))
    asked = [" ".join(rng.choices([*few, "new"], k=40)) for _ in range(5)] + [texts[0][0], texts[1][0]]
    got = [x for a in asked for x in zip(*model.ratios(*toxicity._expressions(words(a), memo)))]
    assert np.allclose(got, plain_ratios(texts, asked), atol=1e-4)


def test_toxicity_of_phrases(docs_of, spark):
    """Two words that are harmless apart and toxic side by side."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(2400):
        ws = rng.choices(VOCAB, k=rng.randint(20, 60)) + ["pure", "filth"] * 2
        rng.shuffle(ws)
        ws = " ".join(ws).replace("pure filth", "filth pure").split()
        if i % 5 == 0:
            at = rng.randrange(len(ws))
            ws[at:at] = ["pure", "filth"]
        rows.append((i, " ".join(ws)))
        labels.append((i, int(i % 5 == 0)))
    got = toxicity.toxicity(docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [(r.predicted, dict(labels)[r.doc_id]) for r in got if r.held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.95


def test_toxicity_bounds_and_repeated_rows(docs_of, spark):
    rows = [(i, " ".join(["good", "day"] * 5 + ["vile"] * (i % 2))) for i in range(40)] * 2 + [(None, "vile")]
    lab = spark.createDataFrame([(i, i % 2) for i in range(40)] * 2, "doc_id long, toxic int")
    whole = toxicity.fit(docs_of(rows), lab, F.lit(True))
    assert whole is not None and abs(whole[2] - 0.5) < 1e-9
    assert toxicity.fit(docs_of(rows), lab, F.lit(True), fit_bytes=0) is None
    assert toxicity.fit(docs_of(rows), lab, F.lit(True), fit_rows=1) is None


def test_packing(docs_of, spark):
    got = packing.pack(docs_of(CORPUS), keep_ids=True, capacity=256).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    tokens = packing.Tokens(packing.ranks_path())
    for i, t in CORPUS:
        parts = sorted(by_doc[i], key=lambda r: r.start)
        copies = sum(1 for j, _ in CORPUS if j == i)
        whole = tokens.ids(t or "") + b"\0" * 4
        assert b"".join(bytes(r.ids) for r in parts[::copies]) == whole
        assert [r.start for r in parts[::copies]] == [s for s, _ in packing.cut(len(whole) // 4, 256)]


def test_packing_of_added_tokens(docs_of):
    rows = packing.pack(docs_of([(1, "end of doc <|endoftext|> next one")]), keep_ids=True).collect()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows] == [[437, 286, 2205, 220, 50256, 1306, 530, 0]]


@pytest.mark.parametrize("tolerance", [0.002, 0.3])
def test_sharding(docs_of, tolerance):
    rows = CORPUS + [(i, BASE) for i in range(400, 700)] + [(700, LONG)] * 50 + [(i, text(i % 40)) for i in range(800, 1200)]
    got = sharding.shard(docs_of(rows), 8, tolerance=tolerance).collect()
    size = lambda t: len((t or "").encode()) + 8
    want = Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    total, slots = Counter(), {}
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
        total[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 8
    mean = sum(total.values()) / 8
    worst = max(2 * tolerance * mean, 2 * max(size(t) for _, t in rows))
    assert all(abs(b - mean) <= worst for b in total.values())


def test_hundreds_of_shards(docs_of):
    rows = [(i, text(1 + i % 3)) for i in range(600)] + [(7, BASE)] * 100
    got = sharding.shard(docs_of(rows), 240).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < 240


def test_write_shards(docs_of, tmp_path, spark):
    rows = [(i, text(i % 30)) for i in range(200)]
    sharding.write_shards(docs_of(rows), str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(rows)


def test_urls(spark):
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("block", "Example.net/")]
    cases = {1: (None, "", "", None, "allow"), 2: ("no-scheme.org/x", "", "", None, "allow"),
             3: ("http://WWW.Example.ORG/en/12#x", "www.example.org", "/en/12", "example.org/en/1", "block"),
             4: ("http://example.org/en?y=/es/", "example.org", "/en", "org/", "allow"),
             5: ("x://example.org", "example.org", "", None, "allow"),
             6: ("http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
             7: ("a://b://example.org/es/", "b:", "//example.org/es/", None, "allow"),
             8: ("http://É.org/\n?", "É.org", "/\n", "org/", "allow"),
             9: ("http://a..example.org/es/", "a..example.org", "/es/", "example.org/es/", "block")}
    pages = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "page_id long, url string")
    for c in ("host", "path", "rule", "verdict", "_best"):
        pages = pages.withColumn(c, F.lit("x"))
    for block in (200_000, 1):
        got = {r.page_id: tuple(r)[1:] for r in urls.judge_urls(pages, rules, block=block).collect()}
        assert got == {k: v[1:] for k, v in cases.items()}


def test_html(spark):
    page = "<html><nav>a b</nav><article><p>x &amp; {}</p></article><footer>f g h</footer></html>"
    rows = [(i, "u", page.format("w " * 20)) for i in range(20)] + [(90, None, None), (91, "u", ""), (None, "u", "<p>p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = html.extract(pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[3] == ("x & " + "w " * 20).strip() and by[90] == by[91] == "" and by[None] == "p"


def test_nearest(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(700, 24)).astype("float32")
    vectors[100:300] = vectors[100]  # a third are one vector
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1001, [0.0] * 24), (1050, [float("nan")] * 24), (1100, [None] * 24), (1150, []),
             (1200, [1.0, 2.0]), (1250, [2.0, 4.0]), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = {}
    for r in ann.nearest(df, F.expr("vec_id % 50 = 0"), k=5, block=6).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    x = vectors.astype(float)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hits = total = 0
    for q in range(0, 700, 50):
        s = unit @ unit[q]
        best = [int(i) for i in sorted(range(700), key=lambda i: (-round(s[i], 12), i)) if i != q][:5]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert all(abs(m[2] - s[m[1]]) < 1e-12 for m in mine)
        hits += len({m[1] for m in mine} & set(best))
        total += 5
    assert hits / total >= 0.9
    assert [m[1] for m in sorted(got[150])] == [100, 101, 102, 103, 104]
    assert [m[1] for m in got[1200]] == [1250] and set(got) == {*range(0, 700, 50), 1200, 1250}


def test_nearest_of_repeated_rows(spark):
    rows = [(0, [1.0, 0.0, 0.0])] + [(1, [1.0, 0.01, 0.0])] * 5 + [(i, [1.0, 0.1 * i, 0.0]) for i in range(2, 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    got = ann.nearest(df, F.expr("vec_id = 0"), k=5, probes=1.0).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id) for r in got] == [(i, i) for i in range(1, 6)]


def test_nearest_returns_all_candidates_if_few(spark):
    rows = [(0, [1.0, 2.0]), (1, [-1.0, -2.0]), (2, [1.0] + [0.0] * 63), (None, [3.0, 1.0]), (9, None)]
    rows += [(10 + i, [-1.0] + [0.01 * (j == i) for j in range(1, 64)]) for i in range(1, 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(df, F.expr("vec_id in (0, 2, 9)"), k=5, block=1).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1)] + [(2, i, 10 + i) for i in range(1, 6)]
    assert abs(got[0].score + 1) < 1e-12
    assert ann.nearest(df, F.expr("vec_id = 9")).count() == 0


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    true = F.lit(True)
    for df in (neardup.near_duplicates(none), substrings.dedup_digest(none), decontaminate.contamination(none, items),
               decontaminate.contamination(docs_of(CORPUS), items), toxicity.toxicity(none, labels), packing.pack(none),
               sharding.shard(none), lm.scores(none, true, ~true), urls.judge_urls(pages, []), html.extract(pages),
               ann.nearest(vectors, true)):
        assert df.count() == 0
