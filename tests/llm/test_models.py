"""Quality, toxicity and personal data: gradients, held-out accuracy, patterns, odd rows; the pipeline."""

import re

import numpy as np
import pytest

import corpus_pipeline
from daypulse.llm import pii, quality, tagger, toxicity
from daypulse.llm.common import table

SF = "/root/testdata/sf0.1"
ODD = [(1, None), (2, ""), (3, " \n"), (4, "x " * 40_000), (4, "x " * 40_000), (None, "y")]


def odd(spark):
    return spark.createDataFrame([(i, t, "l", 0.1, 5) for i, t in ODD], "doc_id long, text string, label string, score double, predicted int")


def held_out(scored, spark, label):
    got = scored.join(table(spark, SF, "labels"), "doc_id").where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").collect()
    y, p = np.array([r[label] for r in got]), np.array([r["predicted"] for r in got])
    return (p[y == 1] == 1).mean(), (p[y == 0] == 0).mean()


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier(spark, module, label):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = module.train(docs, labels)
    hit, clear = held_out(module.score(docs, model), spark, label)
    assert hit >= 0.9 and clear >= 0.95
    got = module.score(odd(spark), model).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1 and len({r["score"] for r in got if r["doc_id"] == 4}) == 1
    assert module.score(docs.limit(0), model).count() == 0
    for few in (labels.limit(0), labels.where(f"{label} = 1"), labels.selectExpr("doc_id", f"cast(null as int) as {label}")):
        assert module.score(docs.limit(3), module.train(docs, few)).count() == 3


def test_quality_gradient():
    rng = np.random.default_rng(0)
    texts = [b"some plain words here " * 30, b"| a | b |" * 40, b"", b"AA!! BB!!" * 20]
    x, bag = quality.passages(texts)
    assert (np.diff(bag) >= 0).all() and set(bag) == {0, 1, 2, 3}
    model = quality.fit(x, bag, np.array([1, 0, 1, 0]), rounds=60)
    assert (quality.scores(texts, model) > 0.5).tolist() == [True, False, True, False]
    long = quality.scores([b" ".join(rng.bytes(4).hex().encode() for _ in range(20_000))], model)
    assert long.shape == (1,)


def test_identity_terms_move_no_score():
    rng = np.random.default_rng(1)
    plain = [b"w%d" % i for i in range(300)]
    def text(bad, term):
        w = list(rng.choice(plain, 12))
        return b" ".join([*w, *([term] if term else [b"scum"] if bad else [])]) + b"."
    # every mention of the term is in a toxic sentence, and some of those have no other sign
    y = np.array([i % 3 == 0 for i in range(900)], int)
    texts = [text(v, b"muslim" if v and i % 2 else b"") for i, v in enumerate(y)]
    bags = [toxicity.sentences([t])[0].ravel() for t in texts]
    fits = {p: toxicity.fit(bags, np.arange(len(y)), y, penalty=p) for p in (0.0, 1.0)}
    neutral = [b"w1 w2 muslim w3.", b"w1 w2 christian w3.", b"w1 w2 w3."]
    with_it = toxicity.scores(neutral, *fits[1.0])
    without = toxicity.scores(neutral, *fits[0.0])
    assert with_it[0] < without[0] and abs(with_it[0] - with_it[1]) < abs(without[0] - without[1])
    assert toxicity.scores([b"w4 scum w5."], *fits[1.0])[0] > 0.5


def test_swaps_are_made_in_the_labelled_sentences():
    """Every mention counts, in its own sentence: one counterfactual for each other term of its row."""
    texts = [b"the muslim went. a christian and a muslim.", b"nothing here.", b"black cat"]
    parts = [toxicity.sentences([t]) for t in texts]
    bags = [p for f, first, _ in parts for p in np.split(f.ravel(), first[1:] * 3)]
    lens = np.array([len(b) for b in bags])
    said, own, other = toxicity.swaps(np.concatenate(bags), np.cumsum(lens) - lens)
    names = [t for row in toxicity.IDENTITY_TERMS for t in row]
    got = [(int(s), names[a], names[b]) for s, a, b in zip(said, own, other)]
    faith, colour = toxicity.IDENTITY_TERMS[0], toxicity.IDENTITY_TERMS[2]
    want = [(0, "muslim", o) for o in faith if o != "muslim"]
    want += [(1, t, o) for t in ("christian", "muslim") for o in faith if o != t]
    want += [(3, "black", o) for o in colour if o != "black"]
    assert sorted(got) == sorted(want)
    assert toxicity.swaps(np.concatenate(toxicity.sentences([b"no term at all"])[:1]).ravel(), np.zeros(1, int))[0].size == 0


def test_fit_reads_every_sentence_and_passage(spark):
    """A sign of the label that stands once, far down in long texts, is learnt."""
    rng = np.random.default_rng(7)
    plain = [f"w{i}" for i in range(200)]
    def long(word, n):
        lines = [" ".join(rng.choice(plain, 8)) for _ in range(n)]
        lines[int(rng.integers(n // 2, n))] += word
        return ". ".join(lines)
    rows = [(i, long(" scum vile filth" if i % 3 == 0 else "", 150), int(i % 3 == 0)) for i in range(150)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert sum(got[i] == y for i, _, y in rows) >= 0.95 * len(rows)


def test_tagger_gradient():
    rng = np.random.default_rng(2)
    model = tagger.new_model(hidden=3, embed=2)
    model = {k: v.astype(np.float64) for k, v in model.items()}
    cls = rng.integers(0, tagger.CLASSES, (4, 7))
    tags = np.zeros((4, 7), int)
    tags[:, 2], tags[:, 3] = 3, 4
    _, grads = tagger.gradients(model, cls, tags)
    for name in ("E", "Wf", "Wb", "O", "T", "bf"):
        for at in [tuple(rng.integers(0, n) for n in model[name].shape) for _ in range(3)]:
            if name == "T" and not tagger.ALLOWED[at]:
                continue
            eps, old = 1e-3, model[name][at]
            model[name][at] = old + eps
            up = tagger.gradients(model, cls, tags)[0]
            model[name][at] = old - eps
            down = tagger.gradients(model, cls, tags)[0]
            model[name][at] = old
            assert abs((up - down) / (2 * eps) - grads[name][at]) < 2e-2 * max(1, abs(grads[name][at]))


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute_spans(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = True
            if k == 1:
                ok = all(int(x) <= 255 for x in m[0].split("."))
            elif k == 2:
                total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
                ok = 13 <= len(digits) <= 19 and total % 10 == 0
            elif k == 3:
                ok = 9 <= len(digits) <= 15
            if ok:
                out.append((k, m.start(), m.end()))
    return out


def test_base_patterns():
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("ab1.@+-_ ()%25é"), int(n))) for n in rng.integers(0, 60, 4000)]
    texts += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111 and 4111111111111112", "+1 (552) 555-3899.", "é a@b.co", "0001.002.3.255"]
    for t in texts:
        assert pii.base_spans(t) == brute_spans(t), t
    for t in ("a" * 200_000, "1" * 200_000, "a@" * 50_000, "1." * 100_000, "+" * 100_000, "9 " * 100_000):
        pii.base_spans(t)  # linear


def test_pii(spark):
    docs = table(spark, SF, "documents")
    model = pii.train(docs)
    odd_rows = spark.createDataFrame(
        [(1, None), (2, ""), (3, "no data"), (4, "é mail a@b.co or 10.0.0.1"), (None, "+1 (552) 555-3899"), (5, "1 " * 60_000)], "doc_id long, text string"
    ).selectExpr("*", "1 as n_email", "'x' as spans")
    got = {r["doc_id"]: r for r in pii.find(odd_rows, model).collect()}
    assert got[4]["spans"] == "email:7:13,ip:17:25" and got[None]["n_phone"] == 1 and got[1]["spans"] == "" and len(got) == 6
    assert pii.find(odd_rows.limit(0), model).count() == 0
    text = {r["doc_id"]: r["text"] for r in pii.mask(odd_rows, model).collect()}
    assert text[4] == "é mail [EMAIL] or [IP]" and text[1] is None and text[3] == "no data"
    # the tagger alone finds most base spans of texts it was not shown, and forms that no pattern has
    rows = docs.where("doc_id % 7 = 3").limit(300).collect()
    base = [set(pii.base_spans(r["text"])) for r in rows]
    tagged = [{s[:3] for s in found} for found in pii.tagged_spans([r["text"] for r in rows], model)]
    assert sum(len(a & b) for a, b in zip(base, tagged)) >= 0.8 * sum(map(len, base))
    (_, added), = pii.all_spans(["the and 552-555-3899 then of the"], model)
    assert added in ([], [(3, 8, 20)])
    assert tagger.fit(np.zeros((0, 64), int), np.zeros((0, 64), int)) is not None


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    kept = docs
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf)
        assert out.columns == corpus_pipeline.COLUMNS, name
        now = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert now <= ids and len(now) > 0.7 * len(ids), name
        ids, kept = now, out.checkpoint()
    texts = [r["text"] for r in kept.select("text").collect()]
    assert not any(pii.base_spans(t) for t in texts)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0
    odd_rows = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a" * 90_000, None, "s", 1)], docs.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:  # the null and the empty text are near copies
        assert stage(spark, odd_rows, sf).count() == (2 if name == "simhash_near_dedup" else 3)
    ends = corpus_pipeline.STAGES[-1][1](spark, odd_rows, sf).where("piece = 0")
    assert {r["doc_id"] for r in ends.collect()} == {1, None, 2}
