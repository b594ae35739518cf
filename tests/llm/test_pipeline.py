"""The whole pipeline on a small table against plain Python versions of its stages; SQL oracles of the operators."""

import os
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from daypulse.llm import pii, queries, toxicity
from daypulse.llm.common import table
from daypulse.llm.tokenizers_path import vocabulary
from tests.compare import compare
from tests.llm.test_dedup import brute_fp, brute_overlaps
from tests.llm.test_models import brute_spans

SF = "/root/testdata/sf0.001"


def brute_one_of_each(rows):
    """Ids that stay: the smallest of each group of fingerprints linked by at most two differing bits."""
    fps = {i: brute_fp(t) for i, t in rows}
    low = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            best = min(low[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2)
            if best < low[i]:
                low[i], changed = best, True
    return {i for i in fps if low[i] == i}


def plain_words(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return " ".join(out)


def test_run_equals_plain_python(spark):
    docs = table(spark, SF, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.train(docs, table(spark, SF, "labels"))
    p = toxicity.scores([(t or "").encode() for t in rows.values()], *model)
    rows = {i: t for (i, t), s in zip(rows.items(), p) if s < 0.5}
    kept = brute_one_of_each(list(rows.items()))
    rows = {i: t for i, t in rows.items() if i in kept}
    tests = {plain_words(r["text"]): r["item_id"] for r in table(spark, SF, "benchmark").collect()}
    ids = list(rows)
    leaked = {ids[r] for r, *_ in brute_overlaps([(i, plain_words(rows[i])) for i in ids], [(k, t) for t, k in tests.items() if t])}
    rows = {i: t for i, t in rows.items() if i not in leaked}

    got, texts = {}, None
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, SF).checkpoint()
        got[name] = {r["doc_id"]: r["text"] for r in current.collect()}
    assert set(got["simhash_near_dedup"]) == kept
    assert set(got["decontamination"]) == set(rows) and leaked
    texts = got["pii"]
    assert set(texts) == set(rows)
    for i, t in rows.items():  # masked at least where the patterns say, and nothing but spans is changed
        for k, a, z in brute_spans(t or ""):
            assert t[a:z] not in texts[i] or t.count(t[a:z]) > 1
        if not brute_spans(t or "") and t == texts[i]:
            continue
        whole, at = t or "", 0
        for part in __import__("re").split(r"\[(?:EMAIL|IP|CARD|PHONE)\]", texts[i] or ""):
            at = whole.index(part, at) + len(part)

    whole = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    packed = corpus_pipeline.run(spark, SF).collect()
    by_doc = {}
    for r in packed:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(rows)
    for i, t in texts.items():
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["piece"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    fill = {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert fill.get(r["sequence_id"], 0) == r["offset"]
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 1024


def test_added_spans_have_forms_that_no_pattern_has(spark):
    """The tagger finds forms that the patterns miss in texts it was not shown, and adds little elsewhere."""
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    model = pii.train(docs)
    rng = np.random.default_rng(3)
    plain = [r["text"][:400] for r in docs.where("doc_id % 7 = 3 and length(text) > 500").limit(200).collect()]
    number = lambda: f"{rng.integers(200, 999)}-{rng.integers(200, 999)}-{rng.integers(1000, 9999)}"
    hidden = [f"{t[:150]} call {(n := number())} now {t[150:300]}" for t in plain]
    spots = [(t.index(" call ") + 6, t.index(" now ")) for t in hidden]
    found = pii.all_spans(hidden, model)
    hit = sum(any(a < e and s < z for _, a, z in added) for (s, e), (_, added) in zip(spots, found))
    false = sum(len(added) for _, added in pii.all_spans(plain, model))
    print(f"added: {hit} of {len(hidden)} hidden numbers found, {false} spans in {len(plain)} plain texts")
    assert hit >= 0.3 * len(hidden) and false <= 0.05 * len(plain)


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    sf = "/root/testdata/sf0.01"
    for name in ("documents", "pages", "conversations"):
        path = f"{sf}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, views, name):
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.01")
    s_cols, d_cols, s_rows, d_rows = compare(df, views, queries.ORACLE[name])
    assert s_cols == d_cols and s_rows == d_rows and s_rows
