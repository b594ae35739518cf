"""SimHash, substring dedup and decontamination against brute force and on odd rows."""

import hashlib
from itertools import combinations

import numpy as np
import pytest
import xxhash

from daypulse.llm import components, decontam, simhash, substring

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, fp string, component_id string, u int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)


def words(n, seed=0):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, 10**9, n)]


def brute_fp(text, shingle=3):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_every_pair_within_the_radius_shares_a_bucket(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for k in range(radius + 1):
        for places in combinations(range(64), k):
            assert any(not any(m >> p & 1 for p in places) for m in masks)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_connect_as_all_pairs_do(spark, radius):
    rng = np.random.default_rng(radius)
    base = [int(x) for x in rng.integers(-(2**62), 2**62, 12)]
    near = [b ^ sum(1 << int(p) for p in rng.integers(0, 63, radius + int(rng.integers(2)))) for b in base for _ in range(6)]
    fps = sorted(set(base + near))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(fps, 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    got = components.connected(simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), radius))
    found = {r["node"]: r["root"] for r in got.collect()}
    assert {f: found.get(f, f) for f in fps} == {f: find(f) for f in fps}


def test_components_of_a_long_chain(spark):
    links = spark.range(200).selectExpr("id as u", "id + 1 as v")
    assert {r["root"] for r in components.connected(links).collect()} == {0}
    assert components.connected(links.limit(0)).count() == 0


def test_simhash_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    fps = {i: brute_fp(t) for i, t in texts.items()}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    comp = {i: i for i in fps}
    for _ in range(len(fps)):
        new = {i: min(comp[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2) for i in fps}
        if new == comp:
            break
        comp = new
    assert {i: r["component_id"] for i, r in got.items()} == comp


def test_simhash_odd_rows(spark):
    long = " ".join(words(60_000))
    rows = [(3, None), (1, ""), (2, " \n\t"), (7, "a b c d e"), (7, "a b c d e"), (5, "A B C D E"), (None, "a b c d e"), (9, "one"), (8, long)]
    got = simhash.near_duplicates(frame(spark, rows))
    by = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()]
    assert len(by) == len(rows)
    assert {c for i, f, c in by if f == "0" * 16} == {1}
    assert sorted((str(i), c) for i, f, c in by if f == f"{brute_fp('a b c d e'):016x}") == [("5", 5), ("7", 5), ("7", 5), ("None", 5)]
    assert next(f for i, f, _ in by if i == 8) == f"{brute_fp(long):016x}"
    kept = simhash.keep_one(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "fp", "component_id", "u"]
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [1, 5, 8, 9]
    assert simhash.near_duplicates(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("few", [10**6, 0])
def test_keep_one_judges_each_row_by_its_own_text(spark, monkeypatch, few):
    """Equal ids with different texts, null ids and rows that are repeated as they are."""
    monkeypatch.setattr(simhash, "FEW", few)
    a, b, c, d = (" ".join(words(40, 60 + k)) for k in range(4))
    rows = [(1, a), (2, a), (2, b), (2, b), (3, b), (None, a), (None, c), (None, c), (4, d), (4, d), (4, a)]
    kept = simhash.keep_one(frame(spark, rows))
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == sorted([("1", a), ("2", b), ("None", c), ("4", d)])
    texts = {t for _, t in rows}
    assert {r["text"] for r in kept.collect()} == texts


def brute_kept(rows, k=20):
    """Kept words of each (id, text); rows that repeat an id and text are one place."""
    first, out = {}, {}
    for i, t in sorted({(i, t or "") for i, t in rows}):
        w = t.encode().split()
        keep = [True] * len(w)
        for s in range(len(w) - k + 1):
            if first.setdefault(tuple(w[s : s + k]), (i, s)) < (i, s):
                keep[s : s + k] = [False] * k
        out[i] = (len(w), len(w) - sum(keep), hashlib.sha256(b" ".join(x for x, y in zip(w, keep) if y)).hexdigest())
    return out


def check_substring(spark, rows, **options):
    got = substring.remove_repeats(frame(spark, rows), **options).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute_kept(rows)
    assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in got)
    assert len(got) == len(rows)


def passages():
    a, b = " ".join(words(60, 1)), " ".join(words(25, 2))
    line = " ".join(words(12, 3))
    rows = [(1, a), (2, "x " + a + " y"), (3, b), (4, " ".join(words(19, 4))), (5, "z " * 300), (6, "z " * 21), (7, None), (8, ""), (3, b)]
    rows += [(100 + i, " ".join(words(30, 50 + i)) + " " + line + " " + " ".join(words(30, 150 + i))) for i in range(30)]
    rows += [(200 + i, a) for i in range(20)] + [(300, b + " é " + b), (301, "q " + " ".join(a.split()[5:26]))]
    return rows


def test_substring_of_different_texts_with_one_id(spark):
    """Rows of one doc_id are documents of their own where their texts differ, in the order of their texts' hash."""
    a, b = " ".join(words(40, 71)), " ".join(words(30, 72))
    rows = [(1, a), (2, "x " + a + " y"), (2, b), (2, b), (2, "q r s t u v w x"), (3, b + " z"), (2, None), (2, "")]
    got = substring.remove_repeats(frame(spark, rows)).collect()
    seen = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got)
    assert seen == sorted([
        (1, 40, 0, a), (2, 42, 40, "x y"), (2, 30, 0, b), (2, 30, 0, b), (2, 8, 0, "q r s t u v w x"), (3, 31, 30, "z"), (2, 0, 0, ""), (2, 0, 0, ""),
    ])


def test_substring_odd_rows(spark):
    check_substring(spark, passages())
    whole = substring.remove_repeats(frame(spark, [(None, "z " * 40), (1, "z " * 40)])).collect()
    assert sorted((r["n_words"], r["n_removed"]) for r in whole) == [(40, 0), (40, 39)] or len(whole) == 2
    assert substring.remove_repeats(frame(spark, passages()).limit(0)).count() == 0


def test_substring_crowded_minimisers_and_short_memory(spark, monkeypatch):
    monkeypatch.setattr(substring, "CROWD", 5)
    monkeypatch.setattr(substring, "MEMORY", 3)
    check_substring(spark, passages())


def test_substring_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    check_substring(spark, [tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("window,wrong", [(16, 3), (15, 3), (14, 2), (13, 2), (12, 2), (11, 2), (10, 2), (9, 1), (8, 1)])
def test_masks_leave_no_overlap_without_a_hit(window, wrong):
    assert window - wrong == int(np.ceil(decontam.SHARE * window))
    for places in combinations(range(window), wrong):
        bad = set(places)
        assert any(not bad & {s + p for p in m} for m in decontam.MASKS for s in range(window - m[-1]))


def test_decontamination(spark):
    item, short = words(30, 5), words(7, 6)
    swapped = list(item[4:24])
    for p in (1, 6, 11, 16, 19):
        swapped[p] = "other"
    test = spark.createDataFrame(
        [(5, " ".join(item), 0), (4, " ".join(item).upper() + "!", 0), (6, " ".join(short), 0), (7, None, 0), (8, "", 0)], "item_id long, text string, doc_id int"
    )
    rows = [
        (1, "so " + ", ".join(item)), (2, " ".join(swapped)), (3, " ".join(item[:12])), (4, " ".join(words(50, 9))), (5, None), (6, ""),
        (7, " ".join(short)), (None, " ".join(item)), (1, "so " + ", ".join(item)), (9, " ".join(words(40_000, 10) + item[:16])),
    ]
    docs = frame(spark, rows)
    got = {(r["doc_id"], r["item_id"], r["matched"], r["window"]) for r in decontam.overlaps(docs, test).collect()}
    best = max(sum(x == y for x, y in zip(swapped[s : s + 16], item[4 + s : 20 + s])) for s in range(5))
    assert best >= 13 and got == {(1, 4, 16, 16), (2, 4, best, 16), (9, 4, 16, 16)}
    kept = decontam.clean(docs, test)
    assert kept.columns == docs.columns and sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 3, 4, 5, 6, 7]
    assert decontam.overlaps(docs.limit(0), test).count() == 0 and decontam.clean(docs, test.limit(0)).count() == len(rows)


def brute_overlaps(rows, items):
    """(row number, item_id, matched, window) by comparing all words at all places."""
    out = set()
    for r, (_, text) in enumerate(rows):
        d = text.split()
        for k, test in items:
            w = test.split()
            span = min(len(w), 16)
            need = -(-4 * span // 5) if len(w) >= 8 else span
            equal = [[0 <= s + i < len(d) and d[s + i] == x for i, x in enumerate(w)] for s in range(-len(w), len(d))]
            best = max((sum(e[a : a + span]) for e in equal for a in range(len(w) - span + 1)), default=0)
            if best >= need:
                out.add((r, k, best, span))
    return out


def test_decontamination_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    letters = [f"w{i}" for i in range(40)]
    items = {" ".join(rng.choice(letters, int(n))) for n in [*range(1, 24)] * 2}
    items = list(enumerate(sorted(items), 100))
    rows = []
    for i in range(150):
        text = list(rng.choice(letters, int(rng.integers(1, 60))))
        for k in rng.integers(0, len(items), 2):
            part = items[k][1].split()
            text[int(rng.integers(0, len(text) + 1)) : 0] = [x if rng.random() > 0.1 else "other" for x in part]
        rows.append((i, " ".join(text)))
    got = decontam.overlaps(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), every=True).collect()
    want = brute_overlaps(rows, items)
    assert {(r["doc_id"], r["item_id"], r["matched"], r["window"]) for r in got} == want and len(got) == len(want)
    assert {r[3] for r in want} >= {1, 2, 3, 7, 8, 16}


def test_decontamination_of_short_unspaced_and_nameless_texts(spark):
    item, short, thai = words(30, 21), words(7, 22), "กรุงเทพมหานคร อมรรัตนโกสินทร์"
    poem, kana = "春眠不觉晓,处处闻啼鸟。夜来风雨声,花落知多少。", "これはテストです"
    test = spark.createDataFrame([(1, " ".join(short)), (2, "Zebra!"), (3, poem), (4, thai), (5, kana), (None, " ".join(item)), (6, "木")], "item_id long, text string")
    rows = [
        (1, "so " + " ".join(short) + " x"), (2, " ".join(short[:6])), (3, "a zebra, here"), (4, "zebras"), (5, "他说:" + poem + "abc"), (6, "春天不冷,处处有花。"),
        (7, "x" + thai), (8, "前" + kana + "後"), (9, " ".join(item)), (10, " ".join(words(50, 23))), (10, " ".join(item[3:])), (None, " ".join(item)),
        (None, " ".join(words(50, 24))), (None, None), (11, "松,木。"), (11, "松"),
    ]
    docs = frame(spark, rows)
    got = [(r["doc_id"], r["item_id"]) for r in decontam.overlaps(docs, test, every=True).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (3, 2), (5, 3), (7, 4), (8, 5), (9, None), (10, None), (None, None), (11, 6)], key=str)
    kept = decontam.clean(docs, test, every=True)
    gone = [rows[i] for i in (0, 2, 4, 6, 7, 8, 10, 11, 14)]
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, (r for r in rows if r not in gone)))


def test_decontamination_is_native(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = decontam.overlaps(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
