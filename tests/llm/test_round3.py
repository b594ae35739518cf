"""HyperMinHash, phrase mining and periodic runs against brute force and on odd rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from daypulse.llm import common, hyperminhash, phrases, queries, runs

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, lang string, key string, node int, id int, runs string"


def frame(spark, rows, lang="en"):
    return spark.createDataFrame([(*r, lang, "x", 1, 2, "y") if len(r) == 2 else (*r, "x", 1, 2, "y") for r in rows], DOCS)


def words(n, seed=0, kinds=10**9):
    return [f"w{x}" for x in np.random.default_rng(seed).integers(0, kinds, n)]


# --- HyperMinHash -----------------------------------------------------------------------


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(w) if len(w) == 1 else frozenset(f"{a} {b}" for a, b in zip(w, w[1:]))


def brute_groups(rows):
    """Row number -> (n, smallest id reachable) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), c := least.get(find(i)), None if d is None or c is None else d == c) for i, (d, _) in enumerate(rows)]


def same_groups(spark, rows):
    got = [tuple(r) for r in hyperminhash.near_duplicates(frame(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_groups(rows)))


def family(seed, copies, changes, length=60):
    rng = np.random.default_rng(seed)
    base = words(length, seed)
    out = []
    for _ in range(copies):
        w = list(base)
        for p in rng.integers(0, length, int(rng.integers(0, changes + 1))):
            w[p] = f"x{rng.integers(10**6)}"
        out.append(" ".join(w))
    return out


def test_minhash_odd_rows(spark):
    long = " ".join(words(30_000, 3))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One"), (6, "one two"), (9, "b c d e f"), (8, "b c d e f g"), (7, "B c d e f"), (7, "other text"),
            (7, "B c d e f"), (None, "b c d e f"), (None, "no id here"), (10, long), (11, long + " end"), (12, "a" * 600 + " z"), (13, "a" * 601 + " z")]
    same_groups(spark, rows)
    assert hyperminhash.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_minhash_families_around_the_threshold(spark):
    rows = [t for k in range(8) for t in family(k, 14, 7)]
    same_groups(spark, list(enumerate(rows, 100)))


def test_minhash_small_sets(spark):
    letters = "a b c d e f".split()
    rng = np.random.default_rng(5)
    rows = [" ".join(rng.choice(letters[:3], int(rng.integers(1, 9)))) for _ in range(120)]
    same_groups(spark, list(enumerate(rows)))


def test_minhash_compares_the_rest_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(hyperminhash, "OUTSIDE", 3)
    monkeypatch.setattr(hyperminhash, "INSIDE", 4)
    monkeypatch.setattr(hyperminhash, "FETCH", 2)
    rows = [t for k in range(3) for t in family(40 + k, 30, 9)]
    same_groups(spark, list(enumerate(rows, 1)))


def test_minhash_small_tables_take_few_partitions(spark, monkeypatch):
    own = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in own}
    kept, found = [], hyperminhash.links
    monkeypatch.setattr(hyperminhash, "links", lambda *a: kept.append(found(*a)) or kept[0])
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        same_groups(spark, list(enumerate([t for k in range(3) for t in family(60 + k, 12, 7)], 1)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert kept[0].rdd.getNumPartitions() == 1  # of 80, each a task and files of every later step


def test_compact_keeps_rows_and_bounds_partitions(spark):
    wide = spark.range(1000, numPartitions=50).unionByName(spark.range(0))
    assert sorted(r["id"] for r in common.compact(wide).collect()) == list(range(1000))
    parts = [common.compact(df, 100).rdd.getNumPartitions() for df in (wide, wide.where("id < 250"), wide.limit(0))]
    assert parts == [10, 3, 1]


def test_estimates_are_near_the_similarity():
    rng = np.random.default_rng(2)
    for common, extra in ((400, 50), (60, 7), (3000, 3000), (0, 500)):
        u = rng.integers(0, 2**63, common + 2 * extra, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(u[: common + extra]), np.unique(np.concatenate((u[:common], u[common + extra :])))
        x = hyperminhash.sketches([a, b])
        got = hyperminhash.estimate(x[:1], x[1:], np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(got - common / (common + 2 * extra)) < 0.16


def test_collisions_of_unlike_sets_are_as_expected():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, 2000, dtype=np.uint64) * np.uint64(2)) for _ in range(800)]
    x = hyperminhash.sketches(sets)
    seen = (x[:400] == x[400:]).mean()
    want = hyperminhash.collisions(np.array([2000]), np.array([2000]))[0]
    assert 0.6 * want < seen < 1.6 * want


# --- phrases ----------------------------------------------------------------------------


def brute_phrases(rows, least, longest, best):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        within = Counter()
        for p, a in cands.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    within[p[i : i + size]] = max(within[p[i : i + size]], a)
        rows_ = []
        for p, a in cands.items():
            if 100 * within[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, le, r) in enumerate(sorted(rows_)[:best], 1):
            out.append((lang, rank, p.decode(), -a, le, r, n[lang], -s))
    return sorted(out)


def same_phrases(spark, rows, least, longest=5, best=2000):
    docs = frame(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows)])
    got = sorted(tuple(r) for r in phrases.collocations(docs, least, longest, best).collect())
    want = brute_phrases(rows, least, longest, best)
    assert got == want
    return want


def phrase_rows():
    rng = np.random.default_rng(8)
    vocab = ["der", "Die", "das", "é", "x-y", "ñ", "Ä", "w" * 300, "w" * 299 + "v", "b"]
    rows = [(" ".join(rng.choice(vocab, int(rng.integers(0, 40)), p=[0.3, 0.2] + [0.0625] * 8)), ["en", "de", None, "und"][i % 4]) for i in range(200)]
    rows += [("a b c d e f. a b\tc d e f! g\x0bh", "en")] * 9 + [("x x x x x x x", "fr")] * 5 + [(None, "fr"), ("", None), ("\n..", "de")]
    return rows


def test_phrases_equal_brute_force(spark):
    assert len(same_phrases(spark, phrase_rows(), 5)) > 100
    same_phrases(spark, phrase_rows(), 4, longest=3, best=7)


def test_phrases_in_several_tries(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD", 9)
    monkeypatch.setattr(phrases, "BLOCK", 500)
    same_phrases(spark, phrase_rows(), 6)


def test_phrases_of_nothing(spark):
    empty = frame(spark, [(1, "a b", "en")])
    assert phrases.collocations(empty.limit(0)).count() == 0
    assert phrases.collocations(empty).count() == 0


def test_scores_beyond_64_bits(spark):
    rows = [("p q " * 5000 + "z " * 60_000, "en")] * 40
    want = same_phrases(spark, rows, 100, longest=2)
    assert any(1000 * a * n > 2**63 or a * n * 1000 > 10**15 for _, _, _, a, _, _, n, _ in want)


def test_trie_finds_what_it_holds():
    rng = np.random.default_rng(4)
    held = np.unique(rng.integers(0, 40, (300, 3)), axis=0).astype(np.int64)
    trie = phrases.Trie(np.arange(len(held)) * 7, held)
    text = rng.integers(0, 45, 5000).astype(np.int64)
    piece = np.sort(rng.integers(0, 200, 5000))
    ids = {tuple(p): i * 7 for i, p in enumerate(held.tolist())}
    want = [ids.get(tuple(text[i : i + 3].tolist()), -1) if i + 3 <= 5000 and piece[i] == piece[i + 2] else -1 for i in range(5000)]
    assert trie.states(text, piece, 3).tolist() == want


# --- periodic runs ----------------------------------------------------------------------


def brute_runs(w, least):
    out, n = set(), len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length, s = j - i + q, w[i : j + q]
            if length >= max(least, 2 * q) and not any(all(s[x] == s[x + p] for x in range(length - p)) for p in range(1, q)):
                out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def found_runs(texts, least):
    first = np.concatenate(([0], np.cumsum([len(w) for w in texts]))).astype(np.int64)
    start, length, period = runs.Factors(np.array([c for w in texts for c in w], np.uint64), first).runs(least)
    at = np.searchsorted(first, start, "right") - 1
    out = [[] for _ in texts]
    for d, s, x, p in zip(at.tolist(), start.tolist(), length.tolist(), period.tolist()):
        out[d].append((s - int(first[d]), x, p))
    return out


@pytest.mark.parametrize("n", range(13))
def test_runs_of_all_binary_words(n):
    texts = [list(c) for c in itertools.product((0, 1), repeat=n)]
    for w, got in zip(texts, found_runs(texts, 2)):
        assert got == brute_runs(w, 2)


def test_runs_of_random_and_periodic_words():
    rng = np.random.default_rng(1)
    texts = []
    for _ in range(1500):
        w = rng.integers(0, rng.integers(1, 5), int(rng.integers(0, 80))).tolist()
        if len(w) > 10 and rng.random() < 0.7:
            a, p = int(rng.integers(0, len(w))), int(rng.integers(1, len(w) // 2 + 1))
            w = [w[i] if i < a else w[min(len(w) - 1, a + (i - a) % p)] for i in range(len(w))]
        texts.append(w)
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    texts.append(b)
    for least in (2, 12):
        for w, got in zip(texts, found_runs(texts, least)):
            assert got == brute_runs(w, least)


def check_runs(spark, rows):
    got = runs.periodic_runs(frame(spark, rows)).collect()
    seen = Counter((r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in got)
    want = Counter()
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        found = brute_runs(w, 12)
        gone = {x for s, n, q in found for x in range(s + q, s + n)}
        want[i, len(w), tuple(found), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    assert seen == want


def test_runs_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "z " * 11), (5, "z " * 12), (5, "z " * 12), (None, "a b é " * 9 + "q"), (6, "a b c " * 4 + "a b c d " * 5),
            (7, " ".join(words(300, 1, 2))), (8, " ".join(words(3000, 2)) + " k l" * 6), (9, " ".join(words(50, 3)) + " " + ("u" * 300 + " " + "u" * 301 + " ") * 7)]
    check_runs(spark, rows)
    assert runs.periodic_runs(frame(spark, rows).limit(0)).count() == 0
    long = runs.periodic_runs(frame(spark, [(1, "a b c " * 100_000)])).first()
    assert [tuple(x) for x in long["runs"]] == [(0, 300_000, 3)] and long["collapsed"] == "a b c"


def test_runs_query_equals_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    planted = 0
    for r in docs:
        w = (r["text"] or "").encode().split()
        n, h = len(w), zlib.crc32(str(r["doc_id"]).encode())
        g = h // 10
        if n > 1500:
            continue
        if h % 10 == 0 and n:
            a, planted = g % n, planted + 1
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute_runs(w, 12)
        gone = {x for s, m, q in found for x in range(s + q, s + m)}
        top = max(found, key=lambda v: (v[1], -v[0], -v[2])) if found else (None,) * 3
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want = (len(found), *top, top[1] * 1000 // top[2] if found else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
        assert got[r["doc_id"]] == want
    assert planted > 5
