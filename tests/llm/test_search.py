"""Fingerprint components, spelling variants and ranked search against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from test_duplicates import in_order, near_copies

from tallyhouse.llm import lexical_search, simhash, spelling
from tallyhouse.llm.text import as_block

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- Fingerprints --------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = WORD.findall(lowered(text).encode())
    shingles = [words[i:i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words][:len(words)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius=3):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


def expected_fingerprints(rows):
    values = [plain_fingerprint(text) for _, text in rows]
    roots = plain_components(values)
    names = {r: min((rows[i][0] for i, s in enumerate(roots) if s == r and rows[i][0] is not None), default=None)
             for r in set(roots)}
    return [(rows[i][0], f"{values[i]:016x}", names[roots[i]]) for i in range(len(rows))]


@pytest.mark.parametrize("cell, chunk", [(4096, 1 << 16), (8, 5), (4096, 16)])
def test_fingerprint_components_equal_all_pairs(frame, cell, chunk):
    rows = near_copies(5, 8, 20, n_words=150) + [(1000 + i, t) for i, (_, t) in enumerate(near_copies(6, 1, 30, n_words=400))]
    found = simhash.simhash_components(frame(rows), cell=cell, chunk=chunk).collect()
    expected = expected_fingerprints(rows)
    assert in_order(map(tuple, found)) == in_order(expected)
    assert len({c for *_, c in expected}) < len({f for _, f, _ in expected}) < len(rows)


def test_fingerprints_of_odd_rows(frame, odd_rows):
    found = simhash.simhash_components(frame(odd_rows)).collect()
    assert in_order(map(tuple, found)) == in_order(expected_fingerprints(odd_rows))
    assert simhash.simhash_components(frame([])).count() == 0
    assert [r.component_id for r in simhash.simhash_components(frame([(None, "a b c d")])).collect()] == [None]


def test_shingle_hash_is_that_of_spark(spark, frame):
    text = "Only A-Z are Lowered, É stays; 漢字 tab\tand  more"
    words = [w.decode() for w in WORD.findall(lowered(text).encode())]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    theirs = [r[0] & ((1 << 64) - 1) for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(
        F.xxhash64("s")).collect()]
    raw, begin, end, _ = simhash.shingle_spans(as_block(pa.array([text])), 3)
    assert [xxhash.xxh64_intdigest(raw[a:b], 42) for a, b in zip(begin, end)] == theirs


def test_long_runs_do_not_overflow_counters():
    hashes = np.full(100_000, (1 << 64) - 1, np.uint64)
    assert simhash.bit_counts(hashes, np.array([0, 300])).tolist() == [[300] * 64, [99_700] * 64]


def test_tiles_find_the_components_of_all_pairs():
    draw = random.Random(3)
    values = [draw.getrandbits(64) for _ in range(40)]
    for _ in range(400):
        value = draw.choice(values)
        for _ in range(draw.randrange(5)):
            value ^= 1 << draw.randrange(64)
        values.append(value)
    array = np.array(values, np.uint64)
    for tile in (7, 64, 1000):
        found = simhash.link_tiles(array, np.zeros(len(array), np.int64), tile=tile)
        groups = lambda roots: {frozenset(np.flatnonzero(roots == r).tolist()) for r in set(roots.tolist())}
        assert groups(found) == groups(np.array(plain_components(values)))
    counts = np.sort(np.bitwise_count(array).astype(np.int64))
    pairs = list(simhash.tile_pairs(counts, 7, 3))
    n_tiles = -(-len(counts) // 7)
    assert len(pairs) < n_tiles * (n_tiles + 1) // 2


def test_radius_has_a_limit(frame):
    with pytest.raises(ValueError):
        simhash.simhash_components(frame([(1, "a")]), radius=4).collect()


# --- Spelling ------------------------------------------------------------------------------------

def one_edit_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected_variants(rows, typo=None, min_length=7, min_count=2, ratio=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if typo and h % typo == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    known = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = {w: [x for x in known if one_edit_apart(w, x)] for w in known}
    form = {}
    for w, n in known.items():
        best = min(((-known[x], x) for x in near[w]), default=(0, None))
        form[w] = best[1] if -best[0] >= ratio * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return [(w, form[w], root(w), n, len(near[w]), form[w] and known[form[w]]) for w, n in known.items()]


def misspelt(seed, n_words, texts):
    draw = random.Random(seed)
    letters = "abcdeéñ"
    words = ["".join(draw.choices(letters, k=draw.randrange(6, 14))) for _ in range(n_words)]
    rows = []
    for i in range(texts):
        chosen = []
        for _ in range(60):
            w = words[min(n_words - 1, int(draw.expovariate(1) * n_words / 8))]
            if draw.random() < 0.3:
                k = draw.randrange(len(w))
                w = draw.choice([w[:k] + w[k + 1:], w[:k] + draw.choice(letters) + w[k:], w[:k] + draw.choice(letters) + w[k + 1:]])
            chosen.append(w.title() if draw.random() < 0.1 else w)
        rows.append((i, draw.choice([" ", "-", "1"]).join(chosen)))
    return rows


@pytest.mark.parametrize("typo, shard", [(None, 1 << 15), (31, 200), (3, 60)])
def test_variants_equal_all_pairs(frame, typo, shard):
    rows = misspelt(1, 60, 120)
    found = spelling.variants(frame(rows), typo=typo, shard_letters=shard).collect()
    expected = expected_variants(rows, typo)
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert any(form for _, form, *_ in expected)
    assert max(n for *_, n, _ in expected) > 3


def test_chains_of_forms_and_ties(frame):
    rows = [(1, " ".join(["aaaaaaa"] * 2 + ["aaaaaab"] * 20 + ["aaaaabb"] * 200 + ["aaaabbb"] * 2000)),
            (2, " ".join(["zzzzzzz"] * 2 + ["zzzzzzy"] * 30 + ["zzzzzzx"] * 30 + ["zzzzzzzz"] * 19))]
    found = {r.word: r for r in spelling.variants(frame(rows)).collect()}
    assert (found["aaaaaaa"].form, found["aaaaaaa"].root) == ("aaaaaab", "aaaabbb")
    assert (found["zzzzzzz"].form, found["zzzzzzz"].form_n, found["zzzzzzz"].n_near) == ("zzzzzzx", 30, 3)
    assert found["zzzzzzzz"].form is None and found["zzzzzzzz"].n_near == 1
    assert sorted(map(tuple, found.values()), key=str) == sorted(expected_variants(rows), key=str)


def test_variants_of_odd_rows(frame, odd_rows):
    long = "y" * 5000
    rows = odd_rows + [(20, f"{long} {long} {long}y {long}y x{long} x{long}"), (21, "ÀÉÎabcd àéîabcd ×÷×÷×÷× ×÷×÷×÷×"), (21, "ÀÉÎabcd")]
    for typo in (None, 3):
        found = spelling.variants(frame(rows), typo=typo).collect()
        assert sorted(map(tuple, found), key=str) == sorted(expected_variants(rows, typo), key=str)
    assert spelling.variants(frame([])).count() == 0
    assert spelling.variants(frame([(1, None), (2, "")])).count() == 0


def test_words_are_counted_in_parts(frame, monkeypatch):
    rows = misspelt(2, 40, 30)
    batch = pa.RecordBatch.from_pydict({"id": [str(i) for i, _ in rows], "text": [t for _, t in rows]})
    monkeypatch.setattr(spelling, "HELD_WORDS", 10)
    parts = list(spelling._counts([batch], 7, None))
    total = Counter()
    for part in parts:
        total.update(dict(zip(part.column(0).to_pylist(), part.column(1).to_pylist())))
    assert len(parts) > 3 and {w: n for w, n in total.items() if n > 1} == {w: n for w, _, _, n, _, _ in expected_variants(rows)}


# --- Search --------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def expected_ranks(rows, items, top=50):
    found = [TERM.findall(lowered(text)) for _, text in rows]
    total, n_docs = sum(map(len, found)), sum(1 for t in found if t)
    counts = [Counter(t) for t in found]
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for (doc_id, _), terms, count in zip(rows, found, counts):
            m = 100 - 50 + (50 * len(terms) * n_docs) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * count[t]) // (1000 * count[t] + 20 * m)) for t in set(TERM.findall(lowered(text))) if count[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(scored[:top], 1)]
    return out


def prose(seed, n, n_terms=300, longest=80):
    draw = random.Random(seed)
    return [(i, " ".join(f"t{int(draw.paretovariate(0.7)) % n_terms}" for _ in range(draw.randrange(longest)))) for i in range(n)]


@pytest.fixture
def items(spark):
    def build(rows):
        return spark.createDataFrame(rows, "item_id bigint, text string").selectExpr(
            "*", "'x' as rank", "'y' as score", "'z' as id", "'w' as block", "'v' as number")
    return build


@pytest.mark.parametrize("window, postings, documents", [(8192, 128, 1 << 16), (64, 8, 100), (7, 3, 40)])
def test_ranks_equal_scores_of_all(frame, items, monkeypatch, window, postings, documents):
    monkeypatch.setattr(lexical_search, "POSTINGS", postings)
    rows, asked = prose(1, 400), [(i, t) for i, t in prose(2, 12, longest=30)]
    found_shards = []
    for part in (rows[:150], rows[150:]):
        block = as_block(pa.array([t for _, t in part]))
        wanted = np.unique(lexical_search.find_terms(as_block(pa.array([t for _, t in asked])))[0])
        shard = lexical_search._Open()
        shard.add(np.array([i for i, _ in part]), block, wanted)
        found_shards.append(shard.row())
    df = np.zeros(len(wanted), np.int64)
    for row in found_shards:
        np.add.at(df, row.column("terms")[0].as_py(), row.column("dfs")[0].as_py())
    corpus = lexical_search.Corpus(*(sum(r.column(c)[0].as_py() for r in found_shards) for c in ("documents", "tokens")), df)
    weights = corpus.weights()
    shards = list(lexical_search._read_shards(found_shards, corpus))
    for item, text in asked:
        hashes = lexical_search.find_terms(as_block(pa.array([text])))[0]
        query = [(int(t), int(weights[t])) for t in np.searchsorted(wanted, np.unique(hashes))]
        best = []
        for shard in shards:
            ids, scores = shard.search(query, 10, window)
            best += zip((-scores).tolist(), ids.tolist())
        found = [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(best)[:10], 1)]
        assert found == expected_ranks(rows, [(item, text)], 10)


def test_blocks_that_cannot_lift_a_candidate_stay_packed(monkeypatch):
    rows = [(i, "common " * (1 + i % 3) + f"filler{i} " * 5 + ("rare " * 30 if i < 5 else "")) for i in range(5000)]
    wanted = np.unique(lexical_search.find_terms(as_block(pa.array(["common rare"])))[0])
    shard = lexical_search._Open()
    shard.add(np.arange(5000), as_block(pa.array([t for _, t in rows])), wanted)
    row = shard.row()
    df = np.zeros(2, np.int64)
    df[row.column("terms")[0].as_py()] = row.column("dfs")[0].as_py()
    corpus = lexical_search.Corpus(row.column("documents")[0].as_py(), row.column("tokens")[0].as_py(), df)
    ready = next(lexical_search._read_shards([row], corpus))
    unpacked, unpack = [], lexical_search.Shard.unpack
    monkeypatch.setattr(lexical_search.Shard, "unpack", lambda self, k, which: unpacked.append(len(which)) or unpack(self, k, which))
    ids, _ = ready.search([(t, int(w)) for t, w in enumerate(corpus.weights())], 5, window=512)
    assert sorted(ids) == [0, 1, 2, 3, 4]
    assert sum(unpacked) < 10 < len(ready.last)


def test_ranked_search_through_spark(frame, items, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_CHARACTERS", 300)
    rows, asked = prose(3, 300), prose(4, 10, longest=30)
    rows += [(1000 + i, t) for i, t in rows[:40]] + rows[:20]
    found = lexical_search.rank_documents(frame(rows), items(asked + asked[:3]), top=9).collect()
    assert in_order(map(tuple, found)) == in_order(expected_ranks(rows, asked, 9))


def test_ranked_search_of_odd_rows(frame, items, odd_rows):
    asked = [(1, "word1 goes one"), (2, None), (3, ""), (4, "!!"), (5, "é 漢字 A b"), (None, "TAIL marks"), (6, "row without"), (6, "end")]
    found = lexical_search.rank_documents(frame(odd_rows), items(asked)).collect()
    assert in_order(map(tuple, found)) == in_order(expected_ranks(odd_rows, [a for a in asked if a[1]]))
    assert lexical_search.rank_documents(frame([]), items(asked)).count() == 0
    assert lexical_search.rank_documents(frame(odd_rows), items([])).count() == 0
