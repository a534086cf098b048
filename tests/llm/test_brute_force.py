"""Operators without a SQL form against brute force on the smallest tables, round trips and held-out accuracy."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tessera.llm import op01_minhash, op03_simhash, op06_packing, op07_substring_dedup, op08_token_counts, op09_repeated_bytes, queries, rolling
from tessera.llm.pretokens import class_table, load, split
from tessera.llm.queries import QUERIES, vocabulary

from ..conftest import SF_SMALL
from .helpers import lower_az, prose, sha

BPE = vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in queries.documents(spark, SF_SMALL).collect()}


def _words(text):
    return lower_az(text).encode().split()


# op1


def test_op1_against_exact_jaccard(spark, texts):
    ids = sorted(texts)
    rows = {r.doc_id: r for r in QUERIES["op1_minhash_fingerprints"](spark, SF_SMALL).collect()}
    assert sorted(rows) == ids

    def shingles(t):
        w = _words(t)
        k = min(5, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    errors = []
    for i, nxt in zip(ids, [*ids[1:], ids[0]]):
        t, n = texts[i], texts[nxt]
        q = len(t) // 4
        e = t[: len(t) - q] + n[:q]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (len(t), sha(e), op01_minhash.fingerprint(t).hex())
        errors += [r.near_edited - like(shingles(t), shingles(e)), r.near_next - like(shingles(t), shingles(n))]
    assert np.abs(errors).max() < 0.2 and np.std(errors) < 0.04 and abs(np.mean(errors)) < 0.01


def test_op1_few_shingles_fill_all_bins():
    for words in (1, 2, 5, 6, 9):
        a, b = prose(words, words), prose(words + 100, words)
        assert op01_minhash.likeness(op01_minhash.fingerprint(a), op01_minhash.fingerprint(a)) == 1.0
        assert op01_minhash.likeness(op01_minhash.fingerprint(a), op01_minhash.fingerprint(b)) < 0.2


# op3


def _simhash(text):
    w = _words(text)
    k = min(3, len(w))
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _components(fps):
    up = {i: i for i in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_op3_against_all_pairs(spark, texts):
    fps = {i: _simhash(t) for i, t in texts.items()}
    want = _components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash_near_dedup"](spark, SF_SMALL).collect()}
    assert got == {i: (format(fps[i], "016x"), want[i]) for i in texts}


@pytest.mark.parametrize("block", [4096, 8])
def test_op3_links_of_crowded_fingerprints(spark, monkeypatch, block):
    """Chains, dense clusters and hot buckets: same components as all pairs, whatever the block size."""
    monkeypatch.setattr(op03_simhash, "BLOCK", block)
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for seed in list(fps)[:6]:
        x = seed
        for _ in range(25):
            x ^= 1 << rng.randrange(20)
            x ^= 1 << rng.randrange(20)
            fps.add(x)
            fps.add(x ^ (1 << 50) ^ (1 << 51) ^ (1 << 52) ^ (1 << 53))
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = op03_simhash.linked_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    want, up = _components(dict(enumerate(fps))), {x: x for x in signed}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for e in edges:
        assert ((e.src ^ e.dst) & ((1 << 64) - 1)).bit_count() >= 0
        up[find(e.src)] = find(e.dst)
    groups = lambda f: sorted(sorted(i for i in range(len(fps)) if f(i) == g) for g in {f(i) for i in range(len(fps))})
    assert groups(lambda i: find(signed[i])) == groups(lambda i: want[i])


def test_op3_thresholds_satisfy_the_pigeonhole():
    rng = np.random.default_rng(2)
    for n in (50, 5000):
        x = (rng.random((n, 64)) < rng.random(64)).astype(float)
        x[:, 10:20] = x[:, 10:11]  # correlated bits
        parts = op03_simhash.allocate(x.T @ x, n)
        assert sorted(b for bits, _ in parts for b in bits) == list(range(64))
        assert sum(t for _, t in parts) == op03_simhash.MAX_BITS - len(parts) + 1


# op6


def test_op6_round_trip(spark, texts):
    tokenizer, docs = load(BPE), {}
    rows = QUERIES["op6_packing"](spark, SF_SMALL).collect()
    windows = {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    for i, t in texts.items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        padding += 1024 - at
    assert padding / sum(r.length for r in rows) < 0.03


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1024), max_size=80))
def test_op6_differencing_keeps_every_piece(sizes):
    parts = op06_packing.pack(sizes, 1024)
    assert sorted(i for p in parts for i in p) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in p) <= 1024 for p in parts)


def test_op6_differencing_balances():
    rng = random.Random(4)
    sizes = [rng.randint(1, 256) for _ in range(900)]
    sums, _ = op06_packing.difference(sizes, 100)
    assert max(sums) - min(sums) <= 16  # of 1133 on average


# op7


def _chunks(b):
    ends = op07_substring_dedup.cuts(np.frombuffer(b, dtype=np.uint8))
    return list(zip([0, *ends], ends))


def test_op7_against_direct_chunk_comparison(spark, texts):
    first = {}
    raw = {i: texts[i].encode() for i in sorted(texts)}
    chunks = {i: _chunks(b) for i, b in raw.items()}
    for i, b in raw.items():
        for a, z in chunks[i]:
            first.setdefault(b[a:z], (i, a))
    got = {r.doc_id: r for r in QUERIES["op7_substring_dedup"](spark, SF_SMALL).collect()}
    for i, b in raw.items():
        runs = []
        for a, z in chunks[i]:
            if first[b[a:z]] != (i, a):
                if runs and runs[-1][1] == a:
                    runs[-1][1] = z
                else:
                    runs.append([a, z])
        runs = [tuple(r) for r in runs if r[1] - r[0] >= op07_substring_dedup.LEAST_RUN]
        kept, at = b"", 0
        for lo, hi in runs:
            kept, at = kept + b[at:lo], hi
        assert [tuple(s) for s in got[i].spans] == runs
        assert got[i].kept_sha256 == sha(kept + b[at:])


def test_op7_chunks_resist_shifts():
    b = prose(8, 3000).encode()
    pieces = lambda x: {x[a:z] for a, z in _chunks(x)}
    assert len(pieces(b) & pieces(b[:500] + b"inserted" + b[500:])) > 0.97 * len(pieces(b))


def test_op7_finds_planted_passages(spark):
    passages = [prose(900 + i, 70) for i in range(20)]
    rows = [(i, f"{prose(i, 90)} {passages[i % 20]} {prose(500 + i, 60)}") for i in range(60)] + [(100 + i, prose(2000 + i, 150)) for i in range(20)]
    got = {r.doc_id: r for r in op07_substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].n_removed == 0 for i in range(20)) and all(got[100 + i].n_removed == 0 for i in range(20))
    assert sum(got[i].n_removed > 0 for i in range(20, 60)) >= 38


# op8


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("ab'stremvld  \n\t19.,é")), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_op8_and_pretokens_agree_with_the_library(text):
    tokenizer = load(BPE)
    assert split(text, class_table(BPE)) == [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert op08_token_counts._counter(BPE)([text]) == [len(want)]
    assert op06_packing.Encoder(BPE).encode(text) == np.array(want, dtype="<u4").tobytes()


@pytest.mark.parametrize("chunk", [1, 5, 256])
def test_op8_chunk_maps_compose(monkeypatch, chunk):
    monkeypatch.setattr(op08_token_counts.mark_starts, "__defaults__", (chunk,))
    texts = ["it's  \n\n I've 're''ll  12ab", "", " ", "x", "<|endoftext|>a <|endoftext|>", "=" * 300 + "'r", "日本 語's"]
    want = [len(load(BPE).encode(t, add_special_tokens=False).ids) for t in texts]
    assert op08_token_counts._counter(BPE)(texts) == want


def test_op8_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(op08_token_counts, "PASS_CHARS", 50)
    t = prose(4, 500).replace(" ", "  ", 40) + "z" * 200
    assert op08_token_counts._counter(BPE)([t, "a b"]) == [len(load(BPE).encode(x, add_special_tokens=False).ids) for x in (t, "a b")]


def test_op8_whole_table(spark, texts):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op8_token_counts"](spark, SF_SMALL).collect()}
    for i, t in texts.items():
        n = len(load(BPE).encode(t, add_special_tokens=False).ids)
        assert got[i] == (len(t.encode()), n, n > 512)


def test_op8_states_may_be_dropped(monkeypatch):
    monkeypatch.setattr(op08_token_counts, "MOST_STATES", 50)
    monkeypatch.setattr(op08_token_counts, "MOST_WORDS", 10)
    c = op08_token_counts.Counter(BPE)
    for s in range(5):
        t = prose(s, 200)
        assert c([t]) == [len(load(BPE).encode(t, add_special_tokens=False).ids)]


# op9


def _brute_spans(docs, match, later_only=False):
    seen = {}
    for k, b in docs:
        for s in range(len(b) - match + 1):
            seen.setdefault(b[s : s + match], []).append((k, s))
    out = {}
    for k, b in docs:
        cover = [False] * len(b)
        for s in range(len(b) - match + 1):
            where = seen[b[s : s + match]]
            if len(where) > 1 and not (later_only and min(where) == (k, s)):
                cover[s : s + match] = [True] * match
        out[k] = cover
    return out


def test_op9_whole_table(spark, texts):
    docs = [(i, texts[i].encode()) for i in sorted(texts)]
    want = _brute_spans(docs, 400)
    got = {r.doc_id: r for r in QUERIES["op9_repeated_bytes"](spark, SF_SMALL).collect()}
    for k, b in docs:
        c = want[k]
        n_spans = sum(x and not (i and c[i - 1]) for i, x in enumerate(c))
        assert (got[k].n_bytes, got[k].n_removed, got[k].n_spans) == (len(b), sum(c), n_spans)
        assert got[k].kept_sha256 == sha(bytes(x for x, y in zip(b, c) if not y))


@pytest.mark.parametrize("block", [4096, 3])
@pytest.mark.parametrize("later_only", [False, True])
def test_op9_small_matches(spark, monkeypatch, block, later_only):
    """Overlaps, periods, tandem repeats and split buckets, against every pair of windows."""
    monkeypatch.setattr(op09_repeated_bytes, "BLOCK", block)
    rng = random.Random(6)
    common = [prose(i, 8) for i in range(3)]
    docs = [(i, "".join(rng.choice([rng.choice(common), prose(i * 50 + j, 4), "ab" * rng.randint(1, 30), "x" * rng.randint(1, 50)]) for j in range(6))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = _brute_spans([(k, t.encode()) for k, t in docs], 24, later_only)
    got = {r.doc_id: r for r in op09_repeated_bytes.remove_repeats(df, 24, 6, later_only).collect()}
    assert {k: got[k].n_removed for k, _ in docs} == {k: sum(c) for k, c in want.items()}
    assert all(got[k].kept_sha256 == sha(bytes(x for x, y in zip(t.encode(), want[k]) if not y)) for k, t in docs)


@given(st.text(alphabet="ab", min_size=12, max_size=120), st.sampled_from([1, 3, 8, 9, 12, 24, 40]))
@settings(max_examples=80, deadline=None)
def test_op9_suffix_order_and_longest_previous_factors(text, match):
    data = (text * 3).encode()
    starts = np.arange(0, len(data) - match + 1, 1 + len(text) % 2)
    if not len(starts):
        return
    rank = op09_repeated_bytes.suffix_ranks(np.frombuffer(data, dtype=np.uint8), starts, match)
    pieces = [data[i : i + match] for i in starts]
    order = sorted(set(pieces))
    assert rank.tolist() == [order.index(x) for x in pieces]
    earlier, later = op09_repeated_bytes.longest_previous(rank, starts, match)

    def agreement(i, j):
        n = 0
        while n < match and data[i + n] == data[j + n]:
            n += 1
        return n

    previous = [max([agreement(i, j) for j in starts if j < i], default=0) for i in starts]
    assert earlier.tolist() == [x == match for x in previous]
    assert later.tolist() == [x in pieces[a + 1 :] for a, x in enumerate(pieces)]


@given(st.lists(st.integers(0, 7), min_size=1, max_size=12), st.sampled_from([3, 8, 24, 40]), st.booleans())
@settings(max_examples=60, deadline=None)
def test_op9_ranks_of_shared_suffixes(parts, match, one_hash):
    """Starts with an equal get the rank of their bytes, others none; hashes that all agree change nothing."""
    units = [prose(900 + i, 6) for i in range(4)] + ["x" * 30, "ab" * 20, "abc" * 9, "y"]
    data = ("".join(units[i] for i in parts) + "z" * match).encode()
    text, starts = np.frombuffer(data, dtype=np.uint8), np.arange(0, len(data) - match + 1, 1 + len(data) % 2)
    pieces = [data[i : i + match] for i in starts]
    shared = {i for i, x in enumerate(pieces) if pieces.count(x) > 1}
    with pytest.MonkeyPatch.context() as m:
        if one_hash:
            m.setattr(op09_repeated_bytes, "window_hash", lambda t, n: np.zeros(len(t) - n + 1, dtype=np.uint64))
        which, rank = op09_repeated_bytes.shared_ranks(text, starts, match)
    assert which.tolist() == sorted(which.tolist()) and shared <= set(which.tolist())
    if not one_hash:
        assert set(which.tolist()) == shared
    order = sorted({pieces[i] for i in which})
    assert rank.tolist() == [order.index(pieces[i]) for i in which]


def test_op9_sorts_a_repeated_suffix_once(monkeypatch):
    """Of four copies between texts of their own, the sort sees the starts of one (all starts of all texts before)."""
    seen, sort = [], op09_repeated_bytes.suffix_ranks
    monkeypatch.setattr(op09_repeated_bytes, "suffix_ranks", lambda t, s, n: seen.append((len(t), len(s))) or sort(t, s, n))
    passage = prose(950, 200)[:900]
    texts = [f"{prose(951 + i, 80)} {i}{passage}{i} {prose(961 + i, 80)}".encode() for i in range(4)]
    rows = [(1, 0, i, 0, 0, len(t) - 399, t, None, None) for i, t in enumerate(texts)]
    batch = op09_repeated_bytes._bucket_rows(rows)
    spans = [r for b in op09_repeated_bytes._spans(400, False)([batch]) for r in b.to_pylist()]
    assert [(r["k"], texts[r["k"]][r["lo"] : r["hi"]].decode()) for r in spans] == [(i, passage) for i in range(4)]
    assert seen == [(900, 501)]


def test_op9_stretches_one_window_at_a_time():
    """Edges, least hashes and the mark of a stretch that may repeat itself, against a plain loop."""
    rng = random.Random(8)
    units = [prose(970 + i, 5) for i in range(3)] + ["x" * 40, "ab" * 25]
    docs = [(i, "".join(rng.choice(units) for _ in range(rng.randint(1, 8)))) for i in range(40)]
    docs = [(i, t) for i, t in docs if len(t) >= 24]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array([0] * len(docs), pa.int32()), pa.array([t for _, t in docs])], names=["k", "h", "text"])
    got = [tuple(r[c] for c in ("k", "at", "starts", "bucket", "weight")) for b in op09_repeated_bytes._stretches(24, 6)([batch]) for r in b.to_pylist()]
    want = []
    for k, t in docs:
        hashes = rolling.window_hash(np.frombuffer(t.encode(), dtype=np.uint8), 6)
        low = [int(hashes[i : i + 19].min()) for i in range(len(t) - 23)]
        a = 0
        for i in range(1, len(low) + 1):
            if i == len(low) or low[i] != low[a]:
                for x in range(a, i, op09_repeated_bytes.STRETCH):
                    y = min(i, x + op09_repeated_bytes.STRETCH)
                    twice = i - a > 19 or (hashes[x : y + 18] == low[a]).sum() > 1
                    want.append((k, x, y - x, low[a] - (1 << 64 if low[a] >> 63 else 0), 2 if twice else 1))
                a = i
    assert got == want


def test_op9_passages_by_length(spark):
    docs, want = [], {}
    for i, n in enumerate([300, 399, 400, 401, 450, 560, 2000]):
        passage = prose(700 + i, 600)[:n]
        for j in range(3):
            docs.append((10 * i + j, f"{prose(10 * i + j, 90)} {j}{passage}{j} {prose(500 + 10 * i + j, 70)}"))
            want[10 * i + j] = n if n >= 400 else 0
    got = {r.doc_id: r.n_removed for r in op09_repeated_bytes.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want


def test_window_hashes_and_minima():
    data = np.frombuffer(prose(3, 200).encode() * 2, dtype=np.uint8)
    for n in (1, 2, 3, 24, 64, 100):
        h = rolling.window_hash(data, n)
        names = {}
        assert len(h) == len(data) - n + 1
        for i, x in enumerate(h.tolist()):
            assert names.setdefault(bytes(data[i : i + n]), x) == x
        assert len(set(names.values())) == len(names)
    v = np.random.default_rng(1).integers(0, 50, 300)
    for w in (1, 2, 7, 64, 300):
        assert rolling.slide_min(v, w).tolist() == [v[i : i + w].min() for i in range(300 - w + 1)]
