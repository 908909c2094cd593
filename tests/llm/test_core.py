"""Pure functions: suffix order, packing plan, sketches, trie, HTML, rotations."""
import random
import time
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import ann, contextmix, html, induced, neardup, packing, substrings, urls
from tessera.llm.common import WordHash, shingle_hashes, words


def brute_order(b):
    sa = sorted(range(len(b)), key=lambda i: b[i:])
    lcp = [0]
    for x, y in zip(sa, sa[1:]):
        k = 0
        while k < induced.CAP and max(x, y) + k < len(b) and b[x + k] == b[y + k]:
            k += 1
        lcp.append(k)
    return sa, lcp


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(min_size=1, max_size=60), st.text("ab", min_size=1, max_size=120).map(str.encode)),
       st.integers(1, 3), st.integers(0, 80))
def test_suffix_order_and_prefixes(b, times, run):
    b = b * times + b"a" * run
    found = list(induced.suffix_order(np.frombuffer(b, np.uint8)))
    got = [np.concatenate([f[i] for f in found]).tolist() for i in (0, 1)]
    assert tuple(got) == tuple(brute_order(b))


def test_suffix_order_spills(monkeypatch):
    monkeypatch.setattr(induced, "FIFO_ROWS", 16)
    b = bytes(random.Random(3).choices(b"abc", k=900)) * 2
    found = list(induced.suffix_order(np.frombuffer(b, np.uint8)))
    assert np.concatenate([p for p, _ in found]).tolist() == brute_order(b)[0]
    assert list(induced.suffix_order(np.empty(0, np.uint8))) == []


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=15))
def test_plan_places_every_piece_once(histogram):
    segments = packing.plan(histogram, 40)
    seen, used = {}, {}
    for length, rank, count, seq, offset in segments:
        for i in range(count):
            assert (length, rank + i) not in seen
            seen[length, rank + i] = 1
            used.setdefault(seq + i, []).append((offset, length))
    assert len(seen) == sum(histogram.values())
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 40
    # the same number of sequences as best-fit decreasing piece by piece
    bins = []
    for length in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        fit = [i for i, room in enumerate(bins) if room >= length]
        if fit:
            bins[min(fit, key=lambda i: bins[i])] -= length
        else:
            bins.append(40 - length)
    assert len(used) == len(bins) and sorted(used) == list(range(len(bins)))


def test_cut():
    assert packing.cut(1) == [(0, 1)]
    assert packing.cut(2048) == [(0, 2048)]
    assert packing.cut(2049) == [(0, 1), (1, 2048)]
    assert packing.cut(4096) == [(0, 2048), (2048, 2048)]


def test_ids_equal_the_tokenizers_library():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    ours = packing.Tokens(packing.ranks_path())
    rng = random.Random(5)
    texts = ["", " ", "  a", "a  ", "a   b\n\n c", "it's don't WE'LL", "x\u00a0y\u3000z", "<|endoftext|> a",
             "é" * 5 + " \t\r\n" * 4, "日本語 テスト 123 45.6", "a\n b \n", "\n", " \n ", "🙂 🙂🙂", "�"]
    texts += ["".join(rng.choices(" \n\tab1.,é'-s", k=rng.randint(1, 60))) for _ in range(400)]
    for text in texts:
        want = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ours.ids(text), "<u4").tolist() == want, text


def test_added_tokens_equal_the_tokenizers_library():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ours = packing.Tokens(packing.ranks_path(), packing.added_tokens())
    rng = random.Random(6)
    texts = ["", "a b", "<|endoftext|>", "end of doc <|endoftext|> next one", "a  <|endoftext|>  b", "<|endoftext|",
             "x<|endoftext|><|endoftext|>\n\ny", "<|<|endoftext|>|>", "<|ENDOFTEXT|>"]
    texts += ["".join(rng.choices([" ", "\n", "<|endoftext|>", "<|", "ab", "1", "'s"], k=rng.randint(1, 30)))
              for _ in range(300)]
    for text in texts:
        want = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ours.ids(text), "<u4").tolist() == want, text


def test_sketch_coordinates_estimate_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    a, b = np.unique(base[:360]), np.unique(base[40:])  # similarity 0.8
    s = neardup.sketch(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), 2000)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.05
    one = neardup.sketch(np.array([7], np.uint64), np.array([0, 1]))
    assert (one != np.iinfo(np.uint64).max).all()  # one shingle fills every coordinate
    alone = neardup.sketch(a, np.array([0, len(a)]), 2000)
    assert (alone[0] == s[0]).all()  # whatever its neighbours in the batch


def test_words_and_shingles():
    assert words("A\u00c9\x0bb\u00a0c\x1cd") == ["a\u00c9".encode(), "b\u00a0c\x1cd".encode()]
    assert words(None) == words("") == words(" \n") == []
    memo = WordHash(2)
    assert len(shingle_hashes(words("a b c"), 5, memo)) == 1
    assert len(shingle_hashes(words("a b c a b"), 2, memo)) == 4 and len(memo) <= 2
    assert shingle_hashes(words("a b"), 2, memo)[0] != shingle_hashes(words("b a"), 2, memo)[0]


def brute_rule(host, path, rules):
    fits = [(h.count("."), len(p), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["allow", "block"]),
                          st.lists(st.sampled_from("ab"), min_size=1, max_size=3).map(".".join),
                          st.text("/xy", max_size=4).map(lambda p: "/" + p if p else "")), max_size=8),
       st.lists(st.sampled_from(["a", "b", ""]), min_size=1, max_size=4).map(".".join), st.text("/xy", max_size=6))
def test_trie_equals_brute_force(rules, host, path):
    hit = urls.Trie(rules).find(host, path)
    want = brute_rule(host, path, rules)
    assert (hit and (hit[2], hit[3])) == want


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul>
<li><a href="/x">menu one</a></li></ul></nav><!-- c --><div class="ad">buy this now</div>{open}<h1>Title &amp; more</h1>
<p>First  <b>bo</b>ld\n words&nbsp;here.<p>Second &lt;p&gt; part<aside>side note</aside>
<div class="comments"><p>reader said</p></div><form>send <input></form></p>{close}<footer>&copy; site</footer></body></html>"""


def test_extraction_with_and_without_marks():
    want = "Title & more\nFirst bold words here.\nSecond <p> part"
    for o, c in (("<article>", "</article>"), ("<main>", "</main>"), ('<div id="content">', "</div>")):
        assert html.extract_text(PAGE.format(open=o, close=c), {}) == want
    for empty in (None, "", "<html></html>", "<nav>a</nav>"):
        assert html.extract_text(empty, {}) == ""
    assert html.extract_text("plain &eacute; text", {}) == "plain é text"
    assert html.extract_text("<p>one<p>two<!-- never closed", {}) == "one\ntwo"


def test_a_small_article_does_not_replace_the_scan():
    body = "".join(f"<p>body part {i} of the page's long main text</p>" for i in range(9))
    for teaser in ("<article>read this too</article>", "<main><p>read this too</p></main>"):
        for page in (f"<div>{body}{teaser}</div>", f"<div>{teaser}{body}</div>"):
            got = html.extract_text(page, {})
            assert all(f"body part {i} of the page's long main text" in got for i in range(9))


@pytest.mark.parametrize("open_, close", [
    ('<div id="content" class="no-comments">', "</div>"), ('<article class="post share">', "</article>"),
    ('<main class="with-sidebar">', "</main>"), ('<div class="has-sidebar"><div class="post share">', "</div></div>"),
    ('<div class="no-ads"><article>', "</article></div>")])
def test_containers_of_the_article_are_no_furniture(open_, close):
    want = "Title & more\nFirst bold words here.\nSecond <p> part"
    page = PAGE.format(open=open_, close=close)
    assert html.extract_text(page, {}) == want
    page = page.replace("<html>", '<html class="no-ads">').replace("<body>", '<body class="has-sidebar">')
    assert html.extract_text(page, {}) == want
    assert html.extract_text(page.replace("<nav>", "<p>Home of things</p><nav>").replace(
        "Second", "Second " + "word " * 40), {}).startswith("Title & more\nFirst bold words here.\nSecond word")


def test_formulas_and_fallback_text_are_kept():
    page = "<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> and <object data='a.swf'>a film</object></p></article>"
    assert html.extract_text(page, {}) == "so x=2 and a film"


@pytest.mark.parametrize("markup, size", [
    ("<a ", 0), ("<div>x", 340_000), ('<a ">" ', 0), ('<a b=">" ', 0), ("<p><b>x", 0), ("<svg>x", 0),
    ("<svg></svg ", 0), ("<!--", 0), ('<div class="ad">x', 0), ("<div></x>", 0)])
def test_broken_and_deep_pages_take_linear_time(markup, size):
    page = markup * (1_000_000 // len(markup))
    began = time.process_time()
    got = html.extract_text(page, {})
    assert time.process_time() - began < 30  # seconds; a quadratic reader takes far longer
    assert not size or abs(len(got) - size) < 10_000


def test_quotes_and_cut_tags():
    assert html.extract_text('<p title="a>b">one</p><p alt=it\'s>two</p>', {}) == "one\ntwo"
    assert html.extract_text('<p>one<p x=">two</p>', {}) == "one\ntwo"  # its quote is never closed
    assert html.extract_text("<p>1 < 2 and a<b</p>", {}) == "1 < 2 and a"
    assert html.extract_text("<p>one</p><p>two <a hre", {}) == "one\ntwo <a hre"


@pytest.mark.parametrize("head", ["<header>{}</header>", '<div class="article-header">{}</div>',
                                  '<header><div class="x">{}</div></header>'])
def test_a_title_in_the_header_of_an_article_stays(head):
    body = "<p>" + "word " * 30 + "</p>"
    page = "<header><h1>Site</h1></header><article>" + head.format("<p>By someone</p><h1>Title</h1>") + body + "</article>"
    assert html.extract_text(page, {}).split("\n")[0] == "Title"
    assert "Site" not in html.extract_text(page, {}) and "someone" not in html.extract_text(page, {})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a ", "b c ", "<p>", "</p>", "<div>", "</div>", "<nav>", "</nav>", "<b>", "</b>",
                                 "<a href='x'>", "</a>", "<li>", "</li>"]), max_size=24))
def test_the_scan_equals_all_runs(parts):
    page = "".join(parts)
    weights = {"word:text": 1.0, "word:a": 0.25, "word:nav": -2.0, "tag:p": -0.5, "tag:div": -1.5, "tag:nav": -4.0,
               "tag:inline": -0.25, "tag:li": -0.75}
    seq = list(html.items(page))
    value = [weights[kind] * (len(text.split()) if what == "text" else 1) for what, kind, text, *_ in seq]
    best, run = 0.0, (0, 0)
    for stop in range(1, len(seq) + 1):
        for start in reversed(range(stop)):  # of equal runs: first end, then last start
            if sum(value[start:stop]) > best:
                best, run = sum(value[start:stop]), (start, stop)
    text = ""
    for what, _, t, frame, _ in seq[slice(*run)]:
        text += (t if frame == 0 else "") if what == "text" else "\n" if t in html.BLOCK else ""
    lines = [" ".join(line.split()) for line in text.split("\n")]
    assert html.extract_text(page, weights) == "\n".join(x for x in lines if x)


def test_rotation_keeps_lengths_and_angles():
    x = np.random.default_rng(0).normal(size=(5, 24))
    y = ann.rotate(x, 3)
    assert y.shape == (5, 32)
    g = y @ y.T / 32 ** 3
    assert np.allclose(g, x @ x.T)
    assert (ann.probe_order(x, 3, 1)[:, 0] == ann.buckets(x, 3)).all()


def test_mixer_is_a_distribution_and_learns():
    rng = np.random.default_rng(0)
    weights = [50, 30, 15, 5]
    tree = contextmix.Tree(weights)
    docs = [rng.choice(4, 60, p=np.array(weights) / 100) for _ in range(30)]
    tables = [np.zeros(2 << contextmix.SLOT_BITS, np.uint32) for _ in range(contextmix.HASHED)]
    contextmix.count_bits(tree, np.concatenate(docs), np.concatenate([np.arange(60)] * 30), tables)
    mixer = contextmix.Mixer(tree, tree.node_odds(weights), [contextmix.shrink(t) for t in tables])
    # all continuations of one length share out exactly 1 (weights move between chunks only)
    pairs = [np.array([i, j]) for i in range(4) for j in range(4)]
    assert abs(np.exp(mixer.score(pairs)).sum() - 1) < 1e-4
    alone = [mixer.score([d])[0] for d in docs[:3]]
    assert np.allclose(alone, mixer.score(docs)[:3], rtol=1e-5)  # neighbours do not matter
    same = np.zeros(400, np.int64) + 3
    assert mixer.score([same])[0] > 0.5 * 400 * np.log(0.05)  # adapts within a document


def test_mixer_learns_from_the_token_two_places_back():
    rng = np.random.default_rng(1)
    tree = contextmix.Tree([1] * 40)
    docs = []
    for _ in range(60):  # every second token tells the one two places on; those between are noise
        doc = rng.integers(0, 40, 60)
        doc[::2] = (doc[0] + 7 * np.arange(30)) % 40
        docs.append(doc)
    tables = [np.zeros(2 << contextmix.SLOT_BITS, np.uint32) for _ in range(contextmix.HASHED)]
    contextmix.count_bits(tree, np.concatenate(docs[:50]), np.concatenate([np.arange(60)] * 50), tables)
    mixer = contextmix.Mixer(tree, tree.node_odds([1] * 40), [contextmix.shrink(t) for t in tables])
    assert mixer.score(docs[50:]).sum() > 0.95 * 10 * 60 * np.log(1 / 40)


def test_whole_characters():
    raw = "aé日b".encode()
    assert substrings.whole_characters(raw, [(0, 2)]) == [(0, 1)]
    assert substrings.whole_characters(raw, [(2, 5)]) == []
    assert substrings.whole_characters(raw, [(1, 7)]) == [(1, 7)]
    assert substrings.merged(None) == []


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51, 200])
def test_anchor_windows_cover_every_window_once(n):
    buf = np.random.default_rng(n).integers(97, 100, n).astype(np.uint8)
    _, _, first, count, _ = substrings._anchors(buf, np.arange(n, 0, -1))
    got = sorted(w for f, c in zip(first, count) for w in range(f, f + c))
    assert got == list(range(max(0, n - 49)))


def test_arrow_tokens_are_the_words_and_an_end(monkeypatch):
    import pyarrow as pa

    from tessera.llm import lm
    texts = [" A\x0bb\x0c\u00c0 c\x1cd\x85e \u00a0F\n", "", None, "x", " \t ", "b A b", "y " * 50, "\u0130 I"]
    column = pa.array(["dropped", *texts]).slice(1)
    for room in (1, 40, 1 << 20):
        monkeypatch.setattr(lm, "TEXT_BYTES", room)
        got, parts = [], 0
        for lo, known, token, n in lm._tokens(column, 3):
            assert lo == len(got) and len(token) == n.sum() and len(n) <= 3
            assert len(set(known[:-1])) == len(known) - 1  # a word is looked up once a part
            ends, parts = np.cumsum(n), parts + 1
            got += [[known[i] for i in token[b - k:b]] for b, k in zip(ends, n, strict=True)]
        assert got == [words(t) + [lm.END] for t in texts] and parts >= 3


def test_doubled_ranks_and_common_prefixes_are_those_of_the_suffixes():
    for seed, kinds in ((1, 2), (2, 5), (3, 40)):
        names = np.random.default_rng(seed).integers(0, kinds, 300)
        names[100:160] = names[:60]
        names = np.unique(names, return_inverse=True)[1]
        want = sorted(range(len(names)), key=lambda i: names[i:].tolist())
        assert np.argsort(induced._doubled(names)).tolist() == want
    raw = b"abcdefghabcdefghijabcdefghabcdefghijk" * 3
    text = np.frombuffer(raw, np.uint8)
    a, b = np.array([0, 0, 10, 36, 110]), np.array([18, 37, 28, 73, 0])
    most = np.array([64, 9, 64, 64, 1])
    most = np.minimum(most, len(raw) - np.maximum(a, b))
    want = [next((k for k in range(m) if raw[i + k] != raw[j + k]), m)
            for i, j, m in zip(a.tolist(), b.tolist(), most.tolist(), strict=True)]
    assert induced._common(induced._eights(text), a, b, most).tolist() == want


def test_snippets_that_share_no_window_are_not_sorted():
    rng = np.random.default_rng(7)
    text = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    core = text(36)  # less than a window: 34 equal bytes were enough to be sorted before
    apart = [text(23) + core + text(23) for _ in range(2)]
    assert not substrings._may_share(apart, [1, 2]).any()
    for cut in range(0, 33):  # a window shared wherever its anchor lies is never lost
        window = text(50)
        both = [text(cut)[:32] + window + text(32 - cut) for _ in range(2)]
        snippets, docs = [], []
        for d, whole in enumerate(both):
            left = np.arange(len(whole), 0, -1)
            _, _, first, n, _ = substrings._anchors(np.frombuffer(whole, np.uint8), left)
            snippets += [whole[i:i + k + 49] for i, k in zip(first, n, strict=True)]
            docs += [d] * len(first)
        kept = substrings._may_share(snippets, docs)
        assert all(k for k, t in zip(kept, snippets, strict=True) if window in t)


def test_anchors_of_repeated_rows_are_packed_in_the_order_they_come():
    start = np.array([3, 40, 3, 40, 7], np.int64)
    doc, th, n = np.array([5, 5, 5, 5, 2]), np.array([1, 1, 1, 1, 9]), np.array([4, 2, 4, 2, 8])
    got = substrings._unpack(substrings._pack(*np.zeros((2, 5), np.uint64), start, n, doc, th))
    assert [c.tolist() for c in got[2:]] == [c.tolist() for c in (start, n, doc, th)]


def peak_mb(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_anchors_are_sent_in_small_rows_and_batches():
    import pyarrow as pa
    rng = np.random.default_rng(11)
    texts = [bytes(rng.integers(97, 123, 100_000).astype(np.uint8)).decode() for _ in range(20)] * 2
    docs = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array([1] * 40, pa.int32()), pa.array(texts)],
                                      names=["_id", "_th", "_t"])
    sent = list(substrings._send(1)(iter([docs])))
    assert max(b.nbytes for b in sent) < 3 << 19  # 2 MB and more, in one batch, before
    rows = [r for b in sent for r in b.to_pylist()]
    assert max(len(r["data"]) for r in rows) < 1 << 19
    # repeats are runs already, of each text's second copy alone; the others' anchors cover every window
    runs = {r["doc"]: substrings.merged([r["data"]]) for r in rows if r["kind"] == substrings.RUNS}
    assert runs == {doc: [(0, 100_000)] for doc in range(20, 40)}
    anchors = [substrings._unpack(r["data"]) for r in rows if r["kind"] == substrings.ANCHORS]
    assert len(anchors) > 2
    _, _, start, windows, doc, th = (np.concatenate(c) for c in zip(*anchors, strict=True))
    assert np.bincount(doc, weights=windows).tolist() == [100_000 - 49] * 20 and set(th.tolist()) == {1}
    assert all((np.diff(start[doc == d]) > 0).all() for d in range(20))


def test_snippets_are_compared_in_bounded_memory():
    rng = np.random.default_rng(12)
    snippets = [bytes(t) for t in rng.integers(97, 123, (25_000, 82)).astype(np.uint8)]
    snippets[24_999] = snippets[3][:60] + snippets[24_999][60:]  # far apart: groups reach over all blocks
    kept = []
    assert peak_mb(lambda: kept.append(substrings._may_share(snippets, range(25_000)))) < 75  # 120 before
    assert np.flatnonzero(kept[0]).tolist() == [3, 24_999]


def test_edges_of_a_common_passage_are_sorted_as_one(monkeypatch):
    import struct
    rng = np.random.default_rng(13)
    passage = bytes(rng.integers(97, 123, 60).astype(np.uint8))
    # contexts differ next to the passage; half of the documents have them before it
    far = [bytes(t) for t in rng.integers(97, 123, (100, 10)).astype(np.uint8)]
    snippets = [f + bytes([128 + i]) + passage for i, f in enumerate(far)]
    snippets += [passage + bytes([128 + i]) + f for i, f in enumerate(far)]
    rows = [(0, substrings.SNIPPETS, doc, None, struct.pack("<IiIB", 1, 0, 100, len(t) - 49) + t)
            for doc, t in enumerate(snippets)]
    sorted_, order = [], substrings.suffix_order
    monkeypatch.setattr(substrings, "suffix_order", lambda text: sorted_.append(len(text)) or order(text))
    out = [r for b in substrings._sort_shards(1)(iter([substrings._batch(rows)])) for r in b.to_pylist()]
    runs: dict = {}
    for r in out:
        runs.setdefault(r["doc"], []).append(r["data"])
    assert {d: substrings.merged(v) for d, v in runs.items()} == {
        d: [(111, 171)] if d < 100 else [(100, 160)] for d in range(1, 200)}
    assert sum(sorted_) == 60  # 200 x 71 before


def test_only_what_fills_a_shard_is_dealt_by_window():
    # a row is some 68 bytes; by window it would be 17 rows
    assert 2 << 20 < substrings.MANY * 68 < substrings.SHARD
