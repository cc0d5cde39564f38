"""Operators over the whole corpus, against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest

from quadrille.llm import chat_parse, chroma, components, line_dedup, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)


def key(r):
    return repr(r)


# --- lines --------------------------------------------------------------------------------------------------------


def line_keys(text):
    return [LOW(x.strip(" \t\n\v\f\r")) for x in (text or "").split("\n")]


def deduped(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    low = -(2**63)
    for r in rows:
        for k in line_keys(r[1]):
            if len(k) >= min_chars:
                holders[k].add(low if r[0] is None else r[0])
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        gone = [len(holders.get(k, ())) >= min_docs and max(holders[k]) != (low if r[0] is None else r[0]) for k in line_keys(r[1])]
        kept = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((r[0], len(lines), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def many_lines():
    hot = "this very common line is in a third of all documents"
    return [(i, "\n".join([f"line number {i} of its own kind", *([hot] if i % 3 == 0 else []), f"shared by a few of them: {i % 40}", "short"]), "en", "s", 1, "", "", "") for i in range(300)]


@pytest.mark.parametrize("rows", [cases.rows(), many_lines()])
def test_lines(spark, rows):
    df = cases.frame(spark, rows).repartition(5)
    want = deduped(rows)
    assert sorted((tuple(r) for r in line_dedup.dedup_digest(df).collect()), key=key) == sorted((r[:4] for r in want), key=key)
    got = line_dedup.dedup_texts(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text or "") for r in got.collect()), key=key) == sorted(((r[0], r[4]) for r in want), key=key)


def test_lines_empty(spark):
    assert line_dedup.dedup_digest(cases.empty(spark)).count() == 0


def test_streaming_of_groups_across_batches():
    """Groups that span batches and partitions give what one batch would."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    rows = sorted({(int(h), 0, -int(i), 0, int(p)) for h, i, p in zip(rng.integers(0, 9, 400), rng.integers(0, 30, 400), rng.integers(0, 3, 400), strict=True)})
    names = ["h1", "h2", "id", "fp", "pos"]

    def batch(part, rs):
        cols = [pa.array([r[0] for r in rs]), pa.array([r[1] for r in rs]), pa.array([-r[2] for r in rs]), pa.array([r[3] for r in rs]), pa.array([r[4] for r in rs], pa.int32()), pa.array([part] * len(rs))]
        return pa.RecordBatch.from_arrays(cols, names=[*names, "part"])

    whole = {tuple(x.values()) for b in line_dedup._drops(3, {})([batch(0, rows)]) for x in b.to_pylist()}
    for cut, size in ((150, 7), (201, 1), (77, 50)):
        parts = [rows[:cut], rows[cut:]]
        split = [[batch(k, p[i : i + size]) for i in range(0, len(p), size)] for k, p in enumerate(parts)]
        border = [type("R", (), x) for bs in split for b in line_dedup._borders(bs) for x in b.to_pylist()]
        shared = line_dedup._fold(border)
        assert {tuple(x.values()) for bs in split for b in line_dedup._drops(3, shared)(bs) for x in b.to_pylist()} == whole


# --- near duplicates ----------------------------------------------------------------------------------------------


def components_of(rows, k, percent):
    """Row numbers by component."""
    sets = []
    for r in rows:
        w = WORD.findall(LOW(r[1] or ""))
        sets.append(({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}) if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    found = defaultdict(list)
    for i in range(len(rows)):
        found[root(i)].append(i)
    return dict(found)


def set_size(text, k):
    w = WORD.findall(LOW(text or ""))
    return len({tuple(w[j : j + k]) for j in range(len(w) - k + 1)}) if len(w) >= k else int(bool(w))


def linked(rows, k, percent):
    low = -(2**63)
    ids = [low if r[0] is None else r[0] for r in rows]
    null = lambda x: None if x == low else x
    return sorted(((null(ids[i]), set_size(rows[i][1], k), null(min(ids[j] for j in members))) for members in components_of(rows, k, percent).values() for i in members), key=key)


def families():
    import random

    r = random.Random(4)
    out, n = [], 0
    for f in range(12):
        base = cases.words(80, 100 + f, 400).split()
        for _ in range(14):
            w = list(base)
            for _ in range(r.randrange(0, 5)):
                w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
            out.append((n, " ".join(w), "en", "s", 1, "", "", ""))
            n += 1
    chain = cases.words(60, 999, 400).split()
    for i in range(20):  # each links with the next only
        out.append((n, " ".join(chain), "en", "s", 1, "", "", ""))
        chain[3 * i] = f"step{i}"
        n += 1
    return out


@pytest.mark.parametrize(("rows", "k", "percent"), [(cases.rows(), 4, 85), (families(), 4, 85), (families(), 5, 80)])
def test_components_of_documents(spark, rows, k, percent):
    df = cases.frame(spark, rows).repartition(4)
    want = linked(rows, k, percent)
    assert sorted((tuple(r) for r in ngram_join.jaccard_components(df, k, percent).collect()), key=key) == want
    if percent == 80:
        assert sorted((tuple(r) for r in ngram_join.representatives(df, k, percent).collect()), key=key) == staying(rows, k, percent)


def staying(rows, k, percent):
    """Rows told apart one by one: of each component the first by id, of rows with the same id any one that stands for it."""
    comps = components_of(rows, k, percent)
    low = -(2**63)
    out = []
    for members in comps.values():
        if not (rows[members[0]][1] or "").split():
            out += [rows[i] for i in members]
            continue
        least = min(low if rows[i][0] is None else rows[i][0] for i in members)
        same = {rows[i] for i in members if (low if rows[i][0] is None else rows[i][0]) == least}
        assert len(same) == 1, "the fixture leaves the choice open"
        out += list(same)
    return sorted(out, key=key)


def test_representatives_go_by_row_not_by_id(spark):
    w, u = cases.words(40, 71), cases.words(40, 72)
    near = w.split()
    near[0] = "changed"
    filled = lambda i, t: (i, t, "en", "s", 1, "", "", "")
    rows = [filled(3, w), filled(7, w), filled(7, u), filled(7, u), filled(None, u + " more"), filled(9, " ".join(near)), filled(None, None), filled(None, None), filled(4, ""), filled(4, "")]
    got = sorted((tuple(r) for r in ngram_join.representatives(cases.frame(spark, rows).repartition(4), 5, 80).collect()), key=key)
    assert got == staying(rows, 5, 80)
    assert [r[:2] for r in got if r[0] in (3, 7, 9)] == [(3, w)]
    only = sorted((r.doc_id, r.text) for r in ngram_join.representatives(cases.frame(spark, rows[:3]), 5, 80).collect())
    assert only == [(3, w), (7, u)]
    twice = cases.frame(spark, [filled(7, u), filled(7, u), filled(7, w), filled(7, w)])
    assert sorted(r.text for r in ngram_join.representatives(twice, 5, 80).collect()) == sorted([u, w])


def test_residual_pairs_are_joined(spark):
    """With no contraction worth its while left, the last join alone must find the links that remain."""
    rows = families()
    df = cases.frame(spark, rows)
    a, b, links = ngram_join.linked_classes(df, 4, 85, dense=10**9)
    assert links and a.count() == len(rows) and b.count() > 0
    for dense in (0, 10**9):  # as many rounds as there can be, and one
        assert sorted((tuple(r) for r in ngram_join.jaccard_components(df, 4, 85, dense).collect()), key=key) == linked(rows, 4, 85)


def test_a_common_shingle_is_dealt_into_shares(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHARE", 4)
    rows = families()
    assert sorted((tuple(r) for r in ngram_join.jaccard_components(cases.frame(spark, rows), 4, 85).collect()), key=key) == linked(rows, 4, 85)


def test_texts_by_id(spark):
    rows = spark.createDataFrame([(i, b"x") for i in range(-500, 500)], "id long, text binary")
    ids = spark.createDataFrame([(i,) for i in range(0, 500, 7)], "id long")
    got = {r.id for r in ngram_join.only_ids(rows, ids, 72).collect()}
    assert set(range(0, 500, 7)) <= got and len(got) < 200
    assert ngram_join.only_ids(rows, ids.limit(0), 0).count() == 0


def test_components_empty(spark):
    assert ngram_join.jaccard_components(cases.empty(spark)).count() == 0
    only = cases.frame(spark, [(1, None, "", "", 0, "", "", ""), (2, "", "", "", 0, "", "", "")])
    assert sorted(tuple(r) for r in ngram_join.jaccard_components(only).collect()) == [(1, 0, 1), (2, 0, 2)]


def test_prefix_size_is_enough():
    for n in range(1, 300):
        p = ngram_join.prefix_size(n, 85)
        least = -(-85 * n // 100)  # a partner holds at least so many of the n
        assert 1 <= p <= n and n - p < least


def test_graph_components(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    got = components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    comp = defaultdict(set)
    for r in got:
        comp[r.comp].add(r.node)
    assert sorted(map(sorted, comp.values())) == [list(range(41)), list(range(100, 140)), [300, 301]]


def shuffled_chain(n):
    order = np.random.default_rng(1).permutation(n + 1).tolist()
    return list(zip(order, order[1:], strict=False))


@pytest.mark.parametrize("pairs", [[(i, i + 1) for i in range(40)], [(i, i + 1) for i in range(1000)], [(1000 - i, 999 - i) for i in range(1000)], shuffled_chain(40), shuffled_chain(300)])
def test_chains_take_few_rounds(spark, pairs):
    got, rounds = components.contracted(spark.createDataFrame(pairs, "a long, b long"))
    rows = got.collect()
    assert len(rows) == len(pairs) + 1 and len({r.comp for r in rows}) == 1
    assert rounds <= math.ceil(math.log2(len(rows)))


# --- chats --------------------------------------------------------------------------------------------------------


def test_chat_roles(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"{'What is it' if t % 2 == 0 else 'It is so'} {c} {t}?\nsecond line of it") for c in range(30) for t in range(6)]
    rows += [(None, None, None, None), (5, 1, "assistant", ""), (7, 0, "stranger", "who"), rows[0]]
    conv = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string").repartition(3)
    out = chat_parse.recovered(conv).collect()
    assert sum(r.n_lines for r in out) == sum((r[3] or "").count("\n") + 1 for r in rows)
    assert sum(r.n_right for r in out) >= 0.95 * sum(r.n_lines for r in out)
    assert chat_parse.digests(chat_parse.recovered(conv.limit(0))).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 13])
def test_chats_however_cut(spark, parts, monkeypatch):
    """One conversation with most of the rows, repeated rows and turn numbers, texts without marker: as decoded in one go."""
    said = ("What now?", "so it is. and on\nand on\n\nEnd.", "", "Bot: no\nUser: yes", "x" * 200, "it - goes on, 3")
    rows = [(4, t // 2, ("user", "assistant", "system")[t % 3], said[t * 7 % 6]) for t in range(300)]
    rows += [(c, t, ("user", "assistant")[t % 2], said[(c + t) % 6]) for c in (1, 9) for t in range(4)]
    rows += [(4, 5, "user", "again")] * 40 + [(None, None, None, None), (None, 2, None, "who"), (12, 0, "user", None)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    monkeypatch.setattr(chat_parse, "PIECE_LINES", 50)
    order = chat_parse.ordered(conv, parts)
    model, seams = chat_parse.learn(order)
    got = defaultdict(list)
    for r in chat_parse.parsed(order, model, seams).collect():
        got[r.conv_id].append(r)
    want = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[0] or 0, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        want[r[0]].append((r[1] or 0, r[2], r[3] or ""))
    counts = np.zeros(chat_parse.LineModel.size())
    for turns in want.values():
        text, path = chat_parse.written_out(turns)
        chat_parse.LineModel.count(path, [chat_parse.features(x) for x in text.split("\n")], counts)
    whole = chat_parse.LineModel(counts)
    assert (whole.move == model.move).all() and (whole.begin == model.begin).all() and all((a == b).all() for a, b in zip(whole.emit, model.emit, strict=True))
    assert len(seams.before) >= (parts == 13) * 8 and set(got) == set(want)
    for conv_id, turns in want.items():
        text, path = chat_parse.written_out(turns)
        pieces = sorted(got[conv_id], key=lambda r: r.start_line)
        parsed = chat_parse.parse(text, whole) if text else [("user", "")]
        assert "".join(r.rendered for r in pieces) == chat_parse.render(parsed) or not text
        assert sum(r.n_turns for r in pieces) == len(parsed) and sum(r.n_lines for r in pieces) == len(path)
        roles = [chat_parse.STATES[s][0] for s in whole.viterbi([chat_parse.features(x) for x in text.split("\n")])]
        assert sum(r.n_right for r in pieces) == sum(a == chat_parse.STATES[p][0] for a, p in zip(roles, path, strict=True))
    digests = sorted(map(key, chat_parse.digests(chat_parse.parsed(order, model, seams)).collect()))
    assert digests == sorted(map(key, chat_parse.digests(chat_parse.recovered(conv, 2)).collect()))


def test_viterbi_is_the_best_path():
    from itertools import product

    m = chat_parse.LineModel()
    seen = [chat_parse.features(x) for x in ("User: hello there", "how are you?", "Assistant: fine", "and more.")]
    score = lambda p: m.begin[p[0]] + sum(m.move[a, b] for a, b in zip(p, p[1:], strict=False)) + sum(m.emit[k][s, f[k]] for s, f in zip(p, seen, strict=True) for k in range(4))
    best = max(product(range(len(chat_parse.STATES)), repeat=4), key=score)
    assert score(best) == score(m.viterbi(seen))
    assert chat_parse.parse("System: be kind\nUser: hi\nAssistant: hello\nagain", m) == [("system", "be kind"), ("user", "hi"), ("assistant", "hello\nagain")]
    assert chat_parse.parse("", m) == [] and chat_parse.render([("user", "x")]) == "<|user|>\nx\n<|end|>\n"


# --- audio --------------------------------------------------------------------------------------------------------


def vector(seed):
    return np.random.default_rng(seed).normal(size=64).tolist()


def test_shifted_recordings_align():
    a = chroma.melody(vector(1))
    cut = chroma.HOP * 6
    p, q = chroma.fingerprint(a), chroma.fingerprint(a[cut:] + np.random.default_rng(0).normal(0, 0.002, len(a) - cut))
    other = chroma.fingerprint(chroma.melody(vector(2)))
    block = chroma.QueryBlock([10, 20], [p, other])
    got = block.matches(q)
    assert [k for k, _, _ in got] == [10] and got[0][1] == 6 and got[0][2] < 0.05
    assert chroma.QueryBlock([], []).matches(q) == [] and not len(chroma.fingerprint(np.zeros(100)))


def test_alignment_tries_every_offset_with_votes():
    """Most votes are for an offset with too little overlap; another one aligns the two."""
    r = np.random.default_rng(3)
    a = r.integers(0, 1 << 32, 400, dtype=np.uint32)
    b = a ^ np.uint32(1)  # one bit wrong everywhere but in few frames
    b[:: 400 // 4] = a[:: 400 // 4]
    b[390:] = a[:10]
    got = chroma.QueryBlock([1], [a]).matches(b)
    assert [(k, o) for k, o, _ in got] == [(1, 0)] and got[0][2] < 0.1
    far = chroma.QueryBlock([1], [a]).matches(np.concatenate([r.integers(0, 1 << 32, (1 << 19) + 9, dtype=np.uint32), a]))
    assert [(k, o) for k, o, _ in far] == [(1, -(1 << 19) - 9)]


def test_alignment_over_rows(spark):
    noisy = lambda v, e: (np.array(v) * 1.0 + e).tolist()
    rows = [(0, vector(1)), (1, vector(1)), (2, noisy(vector(1), 1e-4)), (3, vector(5)), (50, vector(1)), (51, None), (52, []), (100, vector(7)), (None, vector(7))]
    df = spark.createDataFrame(rows, "vec_id long, audio array<double>")
    got = {r["query"]: r for r in chroma.aligned(chroma.fingerprints(df, "vec_id", chroma.melodies)).collect()}
    assert set(got) == {0, 50, 100}
    assert got[0].n_matches >= 2 and got[50].n_matches == got[0].n_matches and got[100].n_matches >= 1
    assert Counter(r.n_equal for r in got.values())[0] == 0
    assert chroma.aligned(chroma.fingerprints(df.limit(0), "vec_id", chroma.melodies)).count() == 0


def test_every_match_is_given(spark):
    """Exact copies, near copies and null ids: the rows and the members give what a search of all pairs does."""
    near = lambda e: (np.array(vector(1)) + e).tolist()
    rows = [(0, vector(1)), (7, vector(1)), (8, near(1e-4)), (9, near(3e-2)), (50, near(1e-4)), (100, vector(3)), (101, vector(3)), (150, vector(4)), (200, None), (None, near(2e-2))]
    df = spark.createDataFrame(rows, "vec_id long, audio array<double>")
    out = chroma.aligned_with_members(chroma.fingerprints(df, "vec_id", chroma.melodies)).collect()
    prints = [chroma.fingerprint(chroma.melody(v)) if v else np.zeros(0, np.uint32) for _, v in rows]
    want = Counter()
    for i, (q, _) in enumerate(rows):
        if q is None or q % 50 or not len(prints[i]):
            continue
        for j, (k, _) in enumerate(rows):
            if i != j:
                want.update((q, k, offset, wrong) for _, offset, wrong in chroma.QueryBlock([q], [prints[i]]).matches(prints[j]))
    members, got = defaultdict(list), Counter()
    for r in out:
        if r.query is None:
            members[r["class"]].append(r.id)
    for r in out:
        if r.query is not None and r.match:
            others = list(members[r.match])
            if r.match == r["class"]:
                others.remove(r.query)
            assert len(others) == r.n_copies
            got.update((r.query, k, r.offset, r.wrong) for k in others)
    assert got == want and want[(100, 101, 0, 0.0)] == 1 and len({k for q, k, _, _ in want if q == 0}) > 2
    assert {r.query: r.n_matches for r in out if r.query is not None} == {q: sum(n for w, n in want.items() if w[0] == q) for q in (0, 50, 100, 150, 200)}
    assert sum(map(len, members.values())) == len(rows)


# --- the pipeline -------------------------------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from test_texts import repetition, secrets

    rows = cases.rows() + [(1000 + r[0], *r[1:]) for r in families() if r[0] is not None] + [(5000 + i, f"{cases.words(40, 7000 + i)}\nthe same closing line in all of these documents", "en", "s", 1, "", "", "") for i in range(6)]
    docs, cols = cases.frame(spark, rows), cases.frame(spark, []).columns
    kept = [r for r in rows if repetition(r[1])[6]]
    state = docs
    want = kept
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        state = stage(spark, state, "")
        if i < 4:
            state.write.parquet(f"{tmp_path}/{i}")
            state = spark.read.parquet(f"{tmp_path}/{i}")
            assert state.columns == cols, name
        got = sorted(((r.doc_id, r.text) for r in state.collect()), key=key) if i < 4 else None
        if name == "line_dedup":
            want = [(r[0], d[4], *r[2:]) for r, d in zip(want, deduped(want), strict=True)]
        elif name == "ngram_jaccard":
            want = staying(want, 5, 80)
        elif name == "secret_scan":
            assert all(secrets(t)[5] == "" or "[SECRET]" in t for _, t in got)
            assert [i for i, _ in got] == [i for i, _ in sorted(((r[0], r[1]) for r in want), key=key)]
            continue
        elif name == "best_fit_packing":
            assert {r.doc_id for r in state.collect()} == {r[0] for r in want}
            continue
        assert got == sorted(((r[0], r[1]) for r in want), key=key), name
