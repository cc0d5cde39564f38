"""Operators on one text at a time, against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import cases
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quadrille.llm import attention_lm, byte_bpe, compress_quality, packing, quality_rules, secret_scan

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(r):
    return repr(r)


# --- quality rules ------------------------------------------------------------------------------------------------


def repetition(text):
    text = text or ""
    ws = WORD.findall(text)
    n, chars = len(ws), sum(map(len, ws))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup, dup_chars = set(), 0, 0
    for x in lines:
        dup += x in seen
        dup_chars += len(x) * (x in seen)
        seen.add(x)
    cover, reps = {}, 0
    for k in quality_rules.COVERAGE_LIMITS:
        c = Counter(tuple(ws[i : i + k]) for i in range(n - k + 1))
        marked = {j for i in range(n - k + 1) if c[tuple(ws[i : i + k])] > 1 for j in range(i, i + k)}
        cover[k] = sum(len(ws[j]) for j in marked)
        reps = len(marked) if k == 8 else reps
    failed = n < 20 or 100 * reps > 30 * n
    total = sum(map(len, lines))
    kept = not failed and 100 * dup_chars <= quality_rules.LINE_LIMIT * total and all(100 * cover[k] <= lim * chars for k, lim in quality_rules.COVERAGE_LIMITS.items())
    return (n, chars, sum(c in "#*$%&|<>" for c in text), dup, reps, failed, kept, dup_chars, *cover.values())


def test_repetition(docs, spark):
    want = sorted(((r[0], *repetition(r[1])) for r in cases.rows()), key=key)
    assert sorted((tuple(r) for r in quality_rules.repetition(docs).collect()), key=key) == want
    kept = sorted((tuple(r) for r in quality_rules.passing(docs).collect()), key=key)
    assert kept == sorted((r for r in cases.rows() if repetition(r[1])[6]), key=key)
    assert quality_rules.repetition(cases.empty(spark)).count() == 0


# --- byte-level BPE -----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.loaded(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def reference(bpe):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text("abtheion ", max_size=200) | st.text("aé日🙂 \n'", max_size=120), st.sampled_from([1, 2, 7, 48]))
def test_bpe_is_tiktoken(bpe, reference, text, leaf):
    text = text.encode("utf-8", "ignore").decode()
    bpe.leaf = leaf
    bpe.known.clear()
    bpe.parts.clear()
    ids = bpe.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=60), st.binary(max_size=60))
def test_bpe_joins(bpe, a, b):
    assert bpe.join(bpe.merge(a), bpe.merge(b)) == bpe.merge(a + b)


def test_bpe_rows(docs, reference, spark):
    def want(t):
        ids = reference.encode_ordinary(t or "")
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()

    args = P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN
    assert sorted((tuple(r) for r in byte_bpe.round_trip(docs, *args).collect()), key=key) == sorted(((r[0], *want(r[1])) for r in cases.rows()), key=key)
    assert byte_bpe.encoded(cases.empty(spark), *args).count() == 0


# --- secrets ------------------------------------------------------------------------------------------------------


def entropy_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        x = m[0]
        if not re.search("[0-9]", x) or any(re.search(p, x) for p in secret_scan.ALLOWED):
            continue
        for _, shape, _, window, bits in secret_scan.CLASSES:
            if re.search(shape, x):
                tops = [sum(secret_scan.scaled(c) for c in Counter(x[i : i + window]).values()) for i in range(len(x) - window + 1)]
                if tops and min(tops) <= secret_scan.most_allowed(window, bits):
                    out.append((m.start(), 3, m.end(), "entropy"))
                break
    return out


def secrets(text):
    text = text or ""
    base = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 8]
    base += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    base += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    base.sort()
    more = [e for e in entropy_spans(text) if not any(b[0] < e[2] and e[0] < b[2] for b in base)]
    said = lambda spans: ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
    n = Counter(k for *_, k in base + more)
    return n["assign"], n["access"], n["hex"], n["entropy"], hashlib.sha256(said(base).encode()).hexdigest(), said(base + more)


def test_secrets(docs, spark):
    got = sorted((tuple(r) for r in secret_scan.secret_spans(docs).collect()), key=key)
    assert got == sorted(((r[0], *secrets(r[1])) for r in cases.rows()), key=key)
    assert any("entropy" in r[-1] for r in got) and any("access" in r[-1] for r in got)
    clean = {r.doc_id: r for r in secret_scan.redacted(docs).collect()}
    assert clean[17].text == "[SECRET] and [SECRET] token: abc secret=short".replace("[SECRET] and", '[SECRET]" and')
    assert clean[17].n_chars == len(clean[17].text) and clean[5].text is None and clean[15].text == cases.rows()[15][1]
    assert secret_scan.redacted(cases.empty(spark)).columns == cases.empty(spark).columns


PATHS_AND_PLACEHOLDERS = [
    ("wJalrXUtnFEMI/K7MDENG/bPxRfiCYzRt5Qm8WvN2", True),
    ("sample/KEY=wJalrXUtnFEMIK7MDENGbPxRfiCYzRt5Qm8WvN2", True),
    ("example-Zq3R8tLw0XyP5vKb7NcA9", True),
    ("MySampleKey=Zq3R8tLw0XyP5vKb7NcA9", True),
    ("Zq3R8tLw0XyP5vKb7NcA9=sample", True),
    ("home/user/project/src2/Main/DocumentReader3", False),
    ("/usr/share/doc/python3/examples/Lib", False),
    ("wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", False),
    ("users/550e8400-e29b-41d4-a716-446655440000/files", False),
    ("2024/01/02/Report_2024_final", False),
    ("xxxx-XXXX-xxxx-XXXX-1234", False),
]


def entropy_found(spark, tokens):
    rows = spark.createDataFrame([(i, f"see {t} there") for i, t in enumerate(tokens)], "doc_id long, text string")
    return [r.n_entropy == 1 and r.spans == f"entropy:4:{4 + len(tokens[r.doc_id])}" for r in secret_scan.secret_spans(rows).orderBy("doc_id").collect()]


def test_paths_and_placeholders_do_not_hide_secrets(spark):
    assert entropy_found(spark, [t for t, _ in PATHS_AND_PLACEHOLDERS]) == [x for _, x in PATHS_AND_PLACEHOLDERS]


def test_every_candidate_is_measured_against_a_class(spark):
    seeds = ["q8z3k1v0x7m5w2j9t4r6y1p8b3n0d7f5g2h9c4l6", "JBSWY3DPEHPK3PXPZ7QWKN2MX5TVRUGA", "qzxkvjwpyhfmbtgdnrlcsaueoi", "QZXKVJWPYHFMBTGDNRLCSAUEOI", "qZxKvJwPyHfMbTgDnRlCsAuEoI"]
    words = ["getUserAuthenticationTokenProvider", "document_name_2024_final", "erberbeeinheitkeiter", "Einungtzheitgeungverlich", "internationalization_of_names", "x" * 40, "_" * 40, "very-long-name-of-a-branch-12"]
    assert entropy_found(spark, seeds + words) == [True] * len(seeds) + [False] * len(words)


# --- packing ------------------------------------------------------------------------------------------------------


def test_chunk_tokenizer_is_the_tokenizer():
    tok = packing.loaded(P.path("word_bpe_49k.json"))
    odd = [f"a{chr(c)}B {chr(c)}1 x{chr(c)}'s" for c in (*range(1, 0x180), 0x3A3, 0x130, 0x301, 0x2028, 0x1F642)]
    for t in [r[1] or "" for r in cases.rows()] + odd + ["<|endoftext|> is text", "It's 123 don't"]:
        assert np.frombuffer(tok.encode(t.encode()), "<u4").tolist() == tok.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_added_tokens_are_as_the_tokenizer_has_them():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    whole, tok = Tokenizer.from_file(path), packing.loaded(path)
    for t in ["<|endoftext|>", "a<|endoftext|>b <|startoftext|> c", "x <|ENDOFTEXT|>y", " <|endoftext|>\n<|endoftext|>é", "<|endoftext|", "the <|startoftext|>The"]:
        assert np.frombuffer(tok.encode(t.encode()), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t
    assert np.frombuffer(tok.encode(b"<|endoftext|>"), "<u4").tolist() == [49407]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit(lengths):
    where, offset, bins = packing.best_fit(lengths, 64)
    used = Counter()
    for w, n in zip(where, lengths, strict=True):
        used[w] += n
    assert all(v <= 64 for v in used.values()) and len(used) == bins
    assert packing.lower_bound(np.array(lengths, np.int64), 64) <= bins
    spans = sorted((w, o, o + n) for w, o, n in zip(where, offset, lengths, strict=True))
    assert all(a[0] != b[0] or a[2] == b[1] for a, b in zip(spans, spans[1:], strict=False))


def test_lower_bound_beats_the_sum():
    assert packing.lower_bound(np.full(10, 40), 64) == 10  # by sum alone it would be 7


@pytest.mark.parametrize("group", [4, 10_000])
def test_packing(docs, spark, group):
    path = P.path("word_bpe_49k.json")
    tok = packing.loaded(path)
    want = []
    for r in cases.rows():
        ids = np.frombuffer(tok.encode((r[1] or "").encode()), "<u4").tolist() + [1]
        want += [(r[0], i // 256, i, len(ids[i : i + 256]), zlib.crc32(np.array(ids[i : i + 256], "<u4").tobytes())) for i in range(0, len(ids), 256)]
    got = packing.pack(packing.token_pieces(docs, path, 256), 256, group).collect()
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    fill = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 256
    assert len(fill) <= packing.lower_bound(np.array([r.length for r in got]), 256) + (2 if group > 100 else 4)
    assert packing.pack(packing.token_pieces(cases.empty(spark), path)).count() == 0


# --- the compression classifier -----------------------------------------------------------------------------------


def test_quality_classifier(spark):
    import random

    r = random.Random(5)
    good = lambda: " ".join(r.choice(["the", "river", "slowly", "runs", "under", "old", "stone", "bridges", "near", "town"]) for _ in range(80))
    bad = lambda: " ".join(r.choice(["BUY", "NOW", "$$$", "%%%", "click", "!!!", "free", "###"]) for _ in range(80))
    data = [(i, good() if i % 3 else bad()) for i in range(240)]
    docs = spark.createDataFrame([*data, (900, None), (901, ""), (None, good()), data[0]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)] + [(5, None, 0), (None, 1, 0), (7777, 0, 0)], "doc_id long, quality int, toxic int")
    got = compress_quality.quality_scores(docs, labels).collect()
    assert len(got) == 244 and all(0 <= x.score <= 1 for x in got)
    held = [x for x in got if x.held_out]
    assert {x.doc_id for x in held} == {i for i, _ in data if zlib.crc32(str(i).encode()) % 4 == 2} | ({900, 901} & {i for i in (900, 901) if zlib.crc32(str(i).encode()) % 4 == 2})
    known = [x for x in held if x.doc_id < 240]
    assert sum(x.predicted == int(x.doc_id % 3 > 0) for x in known) >= 0.95 * len(known)
    assert all(x.predicted == int(x.score >= 0.7) for x in got)


def test_quality_without_classes(spark):
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [x.score for x in compress_quality.quality_scores(docs, labels).collect()] == [0.5]
    assert compress_quality.quality_scores(docs.limit(0), labels).count() == 0


# --- the language model -------------------------------------------------------------------------------------------


def small_tree(n=300):
    r = np.random.default_rng(5)
    tree = attention_lm.Tree(r.integers(0, 50, n).astype(float))
    tree.v[:] = r.normal(0, 0.3, tree.v.shape)
    return r, tree


def loss_of(model, tree, x, ids):
    return -tree.log_probs(model.hidden(x), ids).sum(dtype=np.float64)


def test_gradient():
    r, tree = small_tree()
    m = attention_lm.Attention()
    x, ids = r.integers(0, attention_lm.ROWS, (3, attention_lm.WINDOW)), r.integers(0, 300, 3 * attention_lm.WINDOW)
    g = m.gradient(x, lambda h: tree.gradients(h, ids)[0])
    begin = 0
    for shape in m.SHAPES.values():  # the largest of each part
        size = int(np.prod(shape))
        for i in begin + np.argsort(-np.abs(g[begin : begin + size]))[[0, 5]]:
            at = m.flat[i]
            m.flat[i] = at + 1e-2
            up = loss_of(m, tree, x, ids)
            m.flat[i] = at - 1e-2
            down = loss_of(m, tree, x, ids)
            m.flat[i] = at
            assert abs((up - down) / 2e-2 - g[i]) < 1e-2 + 0.05 * abs(g[i])
        begin += size


def test_causal_and_normalised():
    r, tree = small_tree()
    m = attention_lm.Attention()
    x = r.integers(0, attention_lm.ROWS, (1, attention_lm.WINDOW))
    h = m.hidden(x)
    total = sum(np.exp(tree.log_probs(h, np.full(len(h), c)).astype(float)) for c in range(300))
    assert np.allclose(total, 1, atol=1e-4)
    z = x.copy()
    z[0, 20:] = 0
    assert np.allclose(h[:20], m.hidden(z)[:20], atol=1e-6) and not np.allclose(h[20:], m.hidden(z)[20:], atol=1e-3)


def test_tree_begins_as_the_unigram_model_and_is_short():
    counts = np.random.default_rng(2).zipf(1.3, 2000).clip(0, 10**6).astype(float)
    counts[7] = 0
    tree = attention_lm.Tree(counts)
    share = (counts + attention_lm.SMOOTH) / (counts + attention_lm.SMOOTH).sum()
    h = np.random.default_rng(3).normal(size=(2000, attention_lm.WIDTH)).astype(np.float32)
    assert np.allclose(tree.log_probs(h, np.arange(2000)), np.log(share), atol=1e-3)
    entropy = -(share * np.log2(share)).sum()
    assert entropy <= (share * tree.length).sum() < entropy + 1
    assert not len(attention_lm.Tree(counts).log_probs(h[:0], np.arange(0)))


def test_windows_score_each_token_once():
    """With vectors at 0 a token's score doesn't depend on its window: the sum must be the plain one."""
    end = packing.loaded(P.path("word_bpe_49k.json")).tokenizer.get_vocab_size()
    counts = np.random.default_rng(4).integers(0, 9, end + 1).astype(float)
    s = attention_lm.Scorer(P.path("word_bpe_49k.json"), end, counts, attention_lm.Attention().flat)
    share = (counts + attention_lm.SMOOTH) / (counts + attention_lm.SMOOTH).sum()
    texts = [(r[1] or "").encode() for r in cases.rows()]
    got = s.scores(texts)
    for t, x in zip(texts, got, strict=True):
        ids = np.append(np.frombuffer(s.tok.encode(t), "<u4").astype(int), end)
        assert math.isclose(x, np.log10(share[ids]).sum(), rel_tol=1e-4)


def test_scores_are_those_of_plain_windows():
    """Window by window in plain numpy: each token with the whole of its window before it, at least CONTEXT subwords."""
    end = packing.loaded(P.path("word_bpe_49k.json")).tokenizer.get_vocab_size()
    r = np.random.default_rng(6)
    counts = r.integers(0, 9, end + 1).astype(float)
    tree = attention_lm.Tree(counts)
    tree.v[:] = r.normal(0, 0.2, tree.v.shape)
    m = attention_lm.Attention()
    s = attention_lm.Scorer(P.path("word_bpe_49k.json"), end, counts, np.concatenate([m.flat, tree.flat]))
    w, c = attention_lm.WINDOW, attention_lm.CONTEXT
    assert 2 * c >= w
    for n in (1, w, w + 1, 200):
        ids = r.integers(0, end, n)
        rows = np.concatenate([[attention_lm.ROWS], attention_lm.rows_of(ids[:-1])])
        total, at = 0.0, 0
        while at < n:
            begin = max(0, at - c)
            part = slice(begin, min(begin + w, n))
            total += tree.log_probs(m.hidden(rows[None, part])[at - begin :], ids[at : part.stop]).sum(dtype=float)
            at = part.stop
        assert math.isclose(s.scores_of([ids])[0], total / math.log(10), rel_tol=1e-4)


def test_scores(docs, spark):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = lambda t: WORD.findall(lower(t)) + [None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for r in cases.rows() if not held(r[0]) for w in tokens(r[1]))
    total, v = sum(c.values()), len(c)
    want = Counter()
    for r in cases.rows():
        ts = tokens(r[1])
        want[(r[0], held(r[0]), len(ts), sum(c[w] > 0 for w in ts), total, round(sum(math.log10((c[w] + 1) / (total + v + 1)) for w in ts), 6))] += 1
    got = attention_lm.text_scores(docs, P.path("word_bpe_49k.json")).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert attention_lm.text_scores(cases.empty(spark), P.path("word_bpe_49k.json")).count() == 0


def encoded_rows(spark, texts):
    path = P.path("word_bpe_49k.json")
    end = packing.loaded(path).tokenizer.get_vocab_size()
    docs = spark.createDataFrame([(i, t.encode(), False) for i, t in enumerate(texts)], "doc_id long, text binary, held_out boolean")
    return docs.mapInArrow(attention_lm._encode(path, end), attention_lm.ENCODED), path, end


def test_counts_cover_every_subword(spark):
    texts = [cases.words(900, 31), "", "one two", cases.words(2000, 32)]
    rows, path, end = encoded_rows(spark, texts)
    want = np.bincount(np.concatenate([np.append(np.frombuffer(packing.loaded(path).encode(t.encode()), "<u4"), end) for t in texts]), minlength=end + 1)
    assert (attention_lm.learn(rows, path, end)[0] == want).all()


def test_every_subword_trains(spark):
    import pyarrow as pa

    texts = [cases.words(900, 33), "", "one two", cases.words(31, 34), cases.words(2000, 35)]
    rows, path, end = encoded_rows(spark, texts)
    rows = rows.collect()
    ids = [attention_lm._unpacked(bytes(r.ids)) for r in rows]
    batch = pa.RecordBatch.from_arrays([pa.array([bytes(r.ids) for r in rows], pa.binary())], names=["ids"])
    (out,) = attention_lm._train(np.ones(end + 1))(iter([batch]))
    assert np.frombuffer(zlib.decompress(out.column("blob")[0].as_py()), "<f8")[-1] == sum(map(len, ids))
    before, after, taken = attention_lm.windows_of(ids)
    assert after[taken > 0].tolist() == np.concatenate(ids).tolist()
    assert before[taken > 0].tolist() == np.concatenate([np.append(-1, x[:-1].astype(int)) for x in ids]).tolist()


def test_gradient_of_the_tree():
    r, tree = small_tree()
    h, ids = r.normal(size=(40, attention_lm.WIDTH)).astype(np.float32), r.integers(0, 300, 40)
    loss = lambda: -tree.log_probs(h, ids).sum(dtype=np.float64)
    dh, met, g = tree.gradients(h, ids)
    assert len(set(met.tolist())) == len(met)
    for i in (0, len(met) // 2, len(met) - 1):
        for x, place, want in ((h, (i % 40, 3), dh[i % 40, 3]), (tree.v, (met[i], 2), g[i, 2]), (tree.bias, met[i], g[i, -1])):
            was = x[place]
            x[place] = was + 1e-2
            up = loss()
            x[place] = was - 1e-2
            down = loss()
            x[place] = was
            assert abs((up - down) / 2e-2 - want) < 1e-2 + 0.02 * abs(want)


def test_held_out_text_is_told_better_than_by_counts(spark):
    """Sentences of a small grammar: on texts that were not learnt from the model beats the counts of subwords."""
    import pyarrow as pa

    path = P.path("word_bpe_49k.json")
    tok = packing.loaded(path)
    end = tok.tokenizer.get_vocab_size()
    import random

    r = random.Random(3)
    nouns, verbs, places = "river town bridge garden harbour".split(), "crosses borders follows feeds".split(), "valley plain forest".split()
    text = lambda: " ".join(f"the {r.choice(nouns)} {r.choice(verbs)} the {r.choice(places)} and" for _ in range(60))
    ids = [np.append(np.frombuffer(tok.encode(text().encode()), "<u4"), end) for _ in range(260)]
    counts = np.bincount(np.concatenate(ids[:250]), minlength=end + 1).astype(float)
    batch = pa.RecordBatch.from_arrays([pa.array([attention_lm._packed(x) for x in ids[:250]], pa.binary())], names=["ids"])
    (out,) = attention_lm._train(counts)(iter([batch]))
    total = np.frombuffer(zlib.decompress(out.column("blob")[0].as_py()), "<f8")
    scorer = attention_lm.Scorer(path, end, counts, (total[:-1] / total[-1]).astype(np.float32))
    share = (counts + attention_lm.SMOOTH) / (counts + attention_lm.SMOOTH).sum()
    by_counts = sum(np.log10(share[x]).sum() for x in ids[250:])
    tokens = sum(map(len, ids[250:]))
    assert scorer.scores_of(ids[250:]).sum() / tokens > by_counts / tokens + 0.3


def test_context_tells_rare_subwords_apart():
    """Two rare subwords, each after a cue of its own: after learning, a text that keeps to that is likelier."""
    import pyarrow as pa

    assert 2 * attention_lm.CONTEXT >= attention_lm.WINDOW
    path = P.path("word_bpe_49k.json")
    end = packing.loaded(path).tokenizer.get_vocab_size()
    counts = np.ones(end + 1)
    counts[:300] = 100
    a, b = 40_001, 40_002
    r = np.random.default_rng(8)

    def text(turned):
        parts = [[*r.integers(2, 300, 4), i, (a, b)[i ^ turned]] for i in r.integers(0, 2, 200)]
        return np.append(np.array(parts).ravel(), end)

    batch = pa.RecordBatch.from_arrays([pa.array([attention_lm._packed(text(0)) for _ in range(200)], pa.binary())], names=["ids"])
    (out,) = attention_lm._train(counts)(iter([batch]))
    total = np.frombuffer(zlib.decompress(out.column("blob")[0].as_py()), "<f8")
    scorer = attention_lm.Scorer(path, end, counts, total[:-1] / total[-1])
    r = np.random.default_rng(9)
    right = text(0)
    r = np.random.default_rng(9)
    good, bad = scorer.scores_of([right, text(1)])
    assert good > bad + 20


def test_lm_scores_without_the_tokenizer():
    # The ids are there already; a worker that scores keeps no tokenizer with its caches beside the model.
    packing.loaded.cache_clear()
    scorer = attention_lm.Scorer("no such file", 99, np.ones(100), attention_lm.Attention().flat)
    assert (scorer.scores_of([np.array([5, 7, 99], "<u4")]) < 0).all() and packing.loaded.cache_info().currsize == 0


def test_lm_dictionary_of_a_run_of_documents():
    import tracemalloc

    r = np.random.default_rng(5)
    held = []
    for i in range(400):
        w, n = np.unique(r.integers(0, 2**63, 40) if i % 3 else r.integers(0, 50, 30), return_counts=True)
        held.append((i % 7 == 2, w.astype(np.uint64), n.astype(np.uint32)))
    words, known, places, times = attention_lm._dictionary(held)
    want = {}
    for out, w, n in held:
        for x, k in zip(w.tolist(), n.tolist(), strict=True):
            want[x] = want.get(x, 0) + (0 if out else k)
    assert dict(zip(words.tolist(), known.tolist(), strict=True)) == want and words.tolist() == sorted(want)
    for (_, w, n), p, t in zip(held, places, times, strict=True):
        assert words[np.cumsum(attention_lm._unpacked(p), dtype=np.int64)].tolist() == w.tolist() and attention_lm._unpacked(t).tolist() == n.tolist()
    many = [(False, np.unique(r.integers(0, 2**63, 5000).astype(np.uint64)), np.ones(5000, np.uint32)) for _ in range(200)]
    tracemalloc.start()
    attention_lm._dictionary(many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * sum(w.nbytes for _, w, _ in many)


def test_lm_blocks_of_many_texts_are_scored_as_windows():
    """Texts of all lengths about a block's and a window's in one call: each scored as by plain windows, no place twice."""
    r = np.random.default_rng(11)
    counts = r.integers(0, 9, 400).astype(float)
    tree, m = attention_lm.Tree(counts), attention_lm.Attention()
    tree.v[:] = r.normal(0, 0.3, tree.v.shape)
    m.flat[:] = r.normal(0, 0.4, m.flat.shape)
    s = attention_lm.Scorer("no such file", 399, counts, np.concatenate([m.flat, tree.flat]))
    w, c = attention_lm.WINDOW, attention_lm.CONTEXT
    texts = [r.integers(0, 400, n) for n in (*range(1, 70), 0, 500, 3 * c, 40_000, 1)]
    asked, hidden = [], s._hidden
    s._hidden = lambda rows, first: asked.append(len(first)) or hidden(rows, first)
    got = s.scores_of(texts)
    assert sum(asked) == sum(-(-len(x) // c) for x in texts) and max(asked) <= 2 * attention_lm.SCORED_AT_ONCE
    for ids, x in zip(texts, got, strict=True):
        rows, total, at = np.concatenate([[attention_lm.ROWS], attention_lm.rows_of(ids[:-1])]), 0.0, 0
        while at < len(ids):
            begin = max(0, at - c)
            part = slice(begin, min(begin + w, len(ids)))
            total += tree.log_probs(m.hidden(rows[None, part])[at - begin :], ids[at : part.stop]).sum(dtype=float)
            at = part.stop
        assert math.isclose(x, total / math.log(10), rel_tol=1e-4, abs_tol=1e-9)
    assert len(s.scores_of([])) == 0


def test_lm_tree_is_walked_question_by_question():
    """Trees smaller and larger than the heaviest nodes: sums and gradients are those of each path by itself."""
    for n in (2, 9, 33, 34, 700):
        r = np.random.default_rng(n)
        counts = r.zipf(1.4, n).clip(0, 10**4).astype(float)
        counts[r.integers(0, n, n // 3)] = 0
        tree = attention_lm.Tree(counts)
        tree.v[:] = r.normal(0, 0.5, tree.v.shape)
        ids = np.concatenate([np.arange(n), r.choice(n, 300, p=counts / counts.sum())]) if counts.any() else np.arange(n)
        h = r.normal(size=(len(ids), attention_lm.WIDTH)).astype(np.float32)
        logs, want_dh, want = np.zeros(len(ids)), np.zeros(h.shape), np.zeros((n - 1, attention_lm.WIDTH + 1))
        for k, (x, row) in enumerate(zip(ids, h.astype(float), strict=True)):
            for at in range(tree.begin[x], tree.begin[x] + tree.length[x]):
                node, sign = tree.nodes[at], tree.signs[at]
                z = sign * (tree.v[node] @ row + tree.bias[node])
                logs[k] -= np.log1p(np.exp(-z))
                want_dh[k] -= sign / (1 + np.exp(z)) * tree.v[node]
                want[node] -= sign / (1 + np.exp(z)) * np.append(row, 1)
        dh, met, g = tree.gradients(h, ids)
        full = np.zeros_like(want)
        full[met] = g
        assert np.allclose(tree.log_probs(h, ids), logs, atol=1e-4) and np.allclose(dh, want_dh, atol=1e-4) and np.allclose(full, want, atol=1e-3)
    # Of the largest, most questions are the heaviest nodes': the others are few.
    common = ids[n:]
    assert len(tree._asked(h[n:], common)[-1]) < tree.length[common].sum() / 2
