"""URL filter, packing, search and chat format against brute force and on odd rows."""

import fnmatch
import hashlib
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from daypulse.llm import ann, chat, packing, urlfilter
from daypulse.llm.queries import RULES
from daypulse.llm.tokenizers_path import vocabulary

SF = "/root/testdata/sf0.001"


def test_automaton_is_glob_matching():
    rng = np.random.default_rng(1)
    globs = ["*", "a*b", "*ab", "ab*", "a*b*a", "**b", "abab", "*a" * 40, "b" * 70 + "*", ""][:9]
    texts = ["", "a", "ab", "abab", "b" * 71, "a" * 90] + ["".join(rng.choice(list("abc"), int(n))) for n in rng.integers(0, 60, 200)]
    got = urlfilter.ShiftAnd(globs).match(texts)
    assert got.tolist() == [[fnmatch.fnmatchcase(t, g) for g in globs] for t in texts]


def test_url_filter(spark):
    urls = [
        None, "", "no scheme", "http://NET/x", "http://a.net", "http://a.net?x=/y", "http://A.b.net/en/", "http://example.net/en/1", "x://www.example.net/en/a?b",
        "http://example.net/EN/", "http://notexample.com/de/", "http://example.com/de/x#y", "http://é.org/fr/ü", "http://foo.com/a.net/", "http://casino-x.com/",
        "http://a.net/" + "p" * 50_000, "ftp://a://net/", "http://Ä.NET/", "http://foo.com/x\n.net/",
    ]
    df = spark.createDataFrame([(i, u, "h", "p", "r") for i, u in enumerate([*urls, urls[3]])], "page_id long, url string, host string, path string, rule string")
    got = {r["page_id"]: r for r in urlfilter.judge(df, RULES).collect()}
    assert len(got) == len(urls) + 1
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, best and best.name)
        assert got[i]["verdict"] == (best.verdict if best else "block" if host.startswith("casino-") else "allow")
    assert urlfilter.judge(df.limit(0), RULES).count() == 0 and urlfilter.judge(df, []).where("rule is not null").count() == 0


def test_plan_is_full_and_exact():
    rng = np.random.default_rng(2)
    for counts in ({}, {1: 5}, {1024: 3}, {700: 3, 324: 2, 300: 5}, {int(k): int(v) for k, v in zip(rng.integers(1, 1025, 300), rng.integers(1, 2000, 300))}):
        ranges, bins = packing.plan(counts, 1024)
        load = np.zeros(bins, int)
        done = dict.fromkeys(counts, 0)
        for k, (x, first, base, per, off) in enumerate(ranges):
            after = [r for r in ranges[k + 1 :] if r[0] == x]
            n = (min(r[1] for r in after) if after else counts[x]) - first
            done[x] += n
            load[base : base + n // per] += x * per
        assert done == counts and (not bins or load.max() <= 1024)
        assert bins >= -(-sum(k * v for k, v in counts.items()) // 1024)
    assert sum(packing.fill({3: 9, 5: 2, 7: 1}, 20).values()) and sum(k * v for k, v in packing.fill({3: 9, 5: 2, 7: 1}, 20).items()) == 20


def test_encoder_equals_the_tokenizer():
    path = vocabulary("byte_bpe_50k.json")
    encode = packing.Encoder(path)
    for t in ["", " ", "a b", " a  b ", "a \n b\n\n c ", "x<|endoftext|> y", "é 日本 \u3000z \xa0", "don't 12 3!! \t"]:
        assert encode(t) == np.array(encode.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_tokens_over_a_space_are_kept(spark):
    """Ids of the whole text by the tokenizer itself, also where a token runs over a space."""
    path, rng = vocabulary("byte_bpe_50k.json"), np.random.default_rng(5)
    whole, encode = Tokenizer.from_file(path), packing.Encoder(path)
    assert encode.uncut == ["  ", " \xa0 \xa0"]
    texts = ["a \xa0 \xa0 b", "a \xa0 \xa0", "a \xa0 \xa0 \xa0b", "\xa0 \xa0 b", "x" + " \xa0" * 9 + " y", "a\xa0 \xa0b \xa0 c", "a \n \xa0 \t\xa0 b"]
    texts += ["".join(rng.choice(list(" \xa0 \xa0\n\u3000ab.7é"), int(n))) for n in rng.integers(1, 30, 3000)]
    for t in texts:
        assert encode(t) == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t
    rows = spark.createDataFrame(list(enumerate(texts[:7])), "doc_id long, text string")
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.pack(rows, path).collect()}
    for i, t in enumerate(texts[:7]):
        ids = [*whole.encode(t, add_special_tokens=False).ids, 2]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_packing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "text", "1 as length", "2 as piece", "3 as offset")
    odd = spark.createDataFrame([(10**6, None, 0, 0, 0), (10**6 + 1, "", 0, 0, 0), (None, "a b", 0, 0, 0), (10**6 + 2, "long " * 30_000, 0, 0, 0)], docs.schema)
    both = docs.unionByName(odd)
    path = vocabulary("byte_bpe_50k.json")
    got = [r.asDict() for r in packing.pack(both, path).collect()]
    encode, texts = packing.Encoder(path), {r["doc_id"]: r["text"] for r in both.collect()}
    for i, t in texts.items():
        ids = encode(t or "") + np.array([2], "<u4").tobytes()
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(own):
            assert (r["piece"], r["start"]) == (k, at) and r["ids_crc32"] == zlib.crc32(ids[4 * at : 4 * (at + r["length"])])
            at += r["length"]
        assert 4 * at == len(ids) and (len(own) == 1 or all(r["length"] == 1024 for r in own[1:]))
    bins = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert bins.get(r["sequence_id"], 0) == r["offset"]
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 1024 and len(bins) <= 1.03 * sum(bins.values()) / 1024 + 1
    assert packing.pack(both.limit(0), path).count() == 0


def brute_search(rows, every, k):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = []
    for i, v in rows:
        if i % every == 0:
            s = sorted(((-float(np.dot(np.float64(v), np.float64(w))), j) for j, w in rows if j != i))[:k]
            out += [(i, r + 1, j, x) for r, (x, j) in enumerate(s)]
    return out


def test_search_of_few_rows_is_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(8))]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(60)] + [rows[0], rows[7]]
    bad = [(500, None), (520, [0.0] * 8), (540, [float("nan")] * 8), (560, [1.0, None] * 4), (580, [float("inf")] * 8), (None, rows[1][1]), (600, [1.0]), (620, [])]
    df = spark.createDataFrame([(i, v, 1, 0.5) for i, v in rows + bad], "vec_id long, embedding array<float>, rank int, score double")
    got = ann.search(df, k=5).collect()
    want = brute_search(rows, 20, 5)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [w[:3] for w in sorted(want)]
    assert np.allclose([r["score"] for r in sorted(got, key=lambda r: (r["query_id"], r["rank"]))], [-w[3] for w in sorted(want)])
    assert ann.search(df.limit(0)).count() == 0
    assert ann.search(df.where("vec_id = 0")).count() == 0  # no row but the query


@pytest.mark.parametrize("blocks", [False, True])
def test_search_recall(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(ann, "ENTRIES", 100)
        monkeypatch.setattr(ann, "QUERIES", 10)
    monkeypatch.setattr(ann, "LEAST", 1)
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in e.collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    got = {}
    for r in ann.search(e).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        hit += len(got[ids[i]] & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
        total += 20
    assert hit / total >= 0.9


def brute_chat(rows):
    rows = sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or ""))
    out = {}
    for c, _, role, text in rows:
        d = out.setdefault(c, ["", "", 0])
        d[0] += f"{role or ''}\n{text or ''}\n"
        d[1] += (text or "") if role == "assistant" else ""
        d[2] += 1
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {c: (n, sha(a), len(b), sha(b)) for c, (a, b, n) in out.items()}


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "&lt;&amp;lt;", "<|user|>\nhi</s>\n", "|>\n", "\n\n", "é 日本 &", "", None, "&vb;|", "x" * 60_000]
    rows = [(c, t, ("user", "assistant", "system", "a|>\nb", None)[(c + t) % 5], nasty[(3 * c + t) % len(nasty)]) for c in range(12) for t in range(9)]
    rows += [(3, 4, "user", "tie"), (3, 4, "user", "tie"), (99, 0, "user", "no reply")]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "conv_id long, turn long, role string, text string, n int, piece string")
    got = {r["conv_id"]: r for r in chat.digest(chat.pieces(df)).collect()}
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == brute_chat(rows)
    full = chat.materialise(df).collect()
    assert sum(r["example"] == 1 for r in full) == len({r[0] for r in rows if r[2] == "assistant"})
    assert {c: sum(len(r["text"]) for r in full if r["conv_id"] == c) for c in got} == {c: r["formatted_chars"] for c, r in got.items()}
    for r in full:  # one reply is trainable, and it ends the example
        loss = r["text"][r["loss_start"] : r["loss_end"]]
        assert "<" not in loss and r["text"][r["loss_end"] :] == chat.END and r["text"][: r["loss_start"]].endswith("<|assistant|>\n")
    assert chat.digest(chat.pieces(df.limit(0))).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None), (None, 1, "assistant", "a")], "conv_id long, turn long, role string, text string")
    assert [r["n_turns"] for r in chat.digest(chat.pieces(nulls)).collect()] == [2] and chat.materialise(nulls).count() == 1


def test_chat_expands_every_reply_with_its_prefix(spark, monkeypatch):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "</s>b"), (1, 3, "user", "c"), (1, 4, "assistant", ""), (1, 5, "user", "e"),
            (1, 6, "user", "f"), (2, 0, "user", "no reply"), (None, 0, "assistant", "first"), (None, 0, "user", "then")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    piece = lambda role, text: f"<|{role}|>\n{text.replace('<', '&lt;')}</s>\n"
    all_of = [piece(role, text) for c, _, role, text in rows if c == 1]
    want = {(1, 3, 1, "".join(all_of[:3])), (1, 5, 2, "".join(all_of[:5])), (1, 6, None, all_of[5]), (1, 7, None, all_of[6]),
            (2, 1, None, piece("user", "no reply")), (None, 1, 1, piece("assistant", "first")), (None, 2, None, piece("user", "then"))}
    got = chat.expand(chat.pieces(df))
    assert {(r["conv_id"], r["n"], r["example"], r["text"]) for r in got.collect()} == want and got.count() == len(want)
    digest = chat.digest(chat.pieces(df)).collect()
    assert {r["conv_id"]: (r["n_turns"], r["formatted_chars"], r["loss_chars"]) for r in digest} == {
        1: (7, len("".join(all_of[:3] + all_of[:5])), 5), 2: (1, 0, 0), None: (2, len(piece("assistant", "first")), 5)}
    # the digest reads the examples: what they lose, it loses
    whole = chat.expand
    monkeypatch.setattr(chat, "expand", lambda x: whole(x).where("example is null or example > 1"))
    cut = {r["conv_id"]: r["formatted_chars"] for r in chat.digest(chat.pieces(df)).collect()}
    assert cut[1] == len("".join(all_of[:5])) and cut[None] == 0


def test_chat_is_native(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    plan = chat.digest(chat.pieces(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
