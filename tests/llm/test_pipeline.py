"""The pipeline's stages on awkward documents, each against a plain computation on its input."""

from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barspark.llm import langid, mixing, queries

from .test_neighbours import A_Z, plain_components, plain_fingerprint


def plain_topic(text):
    n = len(text or "")
    if not n:
        return "plain"
    for name, mark, least in (("clauses", ",", 10), ("terse", ".", 15), ("lines", "\n", 3)):
        if text.count(mark) * 1000 >= least * n:
            return name
    return "plain"


def plain_draw(rows, tokens, targets):
    """Ids drawn from (doc_id, text, source, lang) rows that weigh ``tokens``: raking, both rate rules and the draw, in dictionaries."""
    cells = [tuple(v if v in targets[d] else "*" for d, v in zip(("source", "lang", "topic"), (s, l, plain_topic(t)))) for _, t, s, l in rows]
    weight = Counter()
    for c, n in zip(cells, tokens):
        weight[c] += n
    want = []
    for d, dim in enumerate(("source", "lang", "topic")):
        full = {**targets[dim], "*": 1 - sum(targets[dim].values())}
        held = {k for c, n in weight.items() for k in [c[d]] if n > 0}
        total = sum(v for k, v in full.items() if k in held)
        want.append({k: full[k] / total for k in held})
    scale = dict.fromkeys(weight, 1.0)
    for _ in range(200):
        for d, shares in enumerate(want):
            have = Counter()
            for c in weight:
                have[c[d]] += weight[c] * scale[c]
            now = sum(have.values())
            scale = {c: scale[c] * shares.get(c[d], 0.0) * now / have[c[d]] if have[c[d]] > 0 else 0.0 for c in scale}
    wanted = {c: weight[c] * scale[c] for c in weight}
    rate, above = max(scale.values()), 0.0
    for c in sorted(scale, key=lambda c: -scale[c]):
        if above > 0.05 * sum(wanted.values()):
            break
        rate, above = scale[c], above + wanted[c]
    for d in range(3):
        for k in {c[d] for c in weight}:
            mine = [c for c in weight if c[d] == k]
            low, high = 0.0, max(scale.values())
            for _ in range(200):  # bisection for the least rate at which the category keeps 95% of its wanted tokens
                mid = (low + high) / 2
                enough = sum(weight[c] * min(mid, scale[c]) for c in mine) >= 0.95 * sum(wanted[c] for c in mine)
                low, high = (low, mid) if enough else (mid, high)
            rate = max(rate, high)
    drawn = []
    for (i, t, *_), c in zip(rows, cells):
        key = f"{'' if i is None else i}\x1f{hashlib.md5((t or '').encode()).hexdigest()}"
        if int(hashlib.sha256(key.encode()).hexdigest()[:13], 16) / 2**52 < min(1.0, scale[c] / rate):
            drawn.append(i)
    return drawn


def library_counts(texts):
    tok = Tokenizer.from_file(public_tokenizers.path(queries.BYTES))
    return [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]


def rows_of(frame):
    return sorted(((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()), key=str)


def test_stages_on_awkward_documents(spark, edge, nothing):
    docs = edge.cache()
    for name, stage in corpus_pipeline.STAGES:
        before = rows_of(docs)
        out = stage(spark, docs, "")
        assert stage(spark, nothing, "").count() == 0
        if name == "language_id":
            judged = langid.predict(docs, queries.language_models(docs)).filter("not rejected")
            assert sorted((str(r.id) for r in judged.collect())) == sorted(str(i) for i, _ in rows_of(out))
        elif name == "exact_dedup":
            best: dict = {}
            for i, t in before:
                k = (t or "").translate(A_Z)
                if k not in best or (i is not None and (best[k] is None or i > best[k])):
                    best[k] = i
            assert sorted(((i, (t or "").translate(A_Z)) for i, t in rows_of(out)), key=str) == sorted(((i, t) for t, i in best.items()), key=str)
        elif name == "near_dedup":
            prints = [plain_fingerprint(t) for _, t in before]
            roots = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
            low = {r: min((i for (i, _), s in zip(before, roots) if s == r and i is not None), default=None) for r in roots}
            assert sorted((i for i, _ in rows_of(out)), key=str) == sorted(low.values(), key=str)
        elif name == "mix":
            rows = [tuple(r) for r in docs.select("doc_id", "text", "source", "lang").collect()]
            drawn = plain_draw(rows, library_counts([t for _, t, *_ in rows]), queries.MIX)
            assert sorted(map(str, drawn)) == sorted(str(i) for i, _ in rows_of(out))
        else:
            tok = Tokenizer.from_file(public_tokenizers.path(queries.BYTES))
            ids = [(i, tok.encode(t or "", add_special_tokens=False).ids) for i, t in before]
            want = [(i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for i, x in ids]
            assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256) for r in out.collect()), key=str) == sorted(want, key=str)
            break
        assert out.columns == edge.columns
        docs = out.cache()


def test_run_keeps_clean_distinct_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    accepted = corpus_pipeline.language_id(spark, docs, sf_dir)
    assert accepted.count() >= 0.99 * docs.count()
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert out and len({r.doc_id for r in out}) == len(out)


def test_mix_weighs_the_tokens_of_the_vocabulary(spark, edge, nothing):
    got = edge.select("doc_id", "text", queries.token_weights(F.col("text")).alias("n")).collect()
    assert [r.n for r in got] == library_counts([r.text for r in got])
    assert nothing.select(queries.token_weights(F.col("text"))).collect() == []
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source", "lang").collect()]
    out = corpus_pipeline.mix_sources(spark, docs, "")
    drawn = plain_draw(rows, library_counts([t for _, t, *_ in rows]), queries.MIX)
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(drawn)
    assert drawn and len(drawn) < len(rows)


def test_mix_takes_a_column_of_topics(spark):
    rows = spark.createDataFrame([(i, "a, b", "s", "en", None if i % 5 == 0 else "ab"[i % 2], 4) for i in range(400)], "doc_id long, text string, source string, lang string, about string, n long")
    targets = {"source": {"s": 1.0}, "lang": {"en": 1.0}, "topic": {"a": 0.8, "b": 0.1}}
    out = mixing.mix(rows, targets, tokens="n", topic="about")
    assert {r.topic for r in out.collect()} == {"a", "b", "*"}
    kept = sorted(r.id for r in out.filter("kept").collect())
    assert kept == sorted(r.doc_id for r in mixing.sample(rows, targets, tokens="n", topic="about").collect())
    reached = {r.category: r.reached for r in mixing.margins(rows, targets, tokens="n", topic="about").filter("dimension = 'topic'").collect()}
    assert abs(reached["a"] - 0.8) < 0.04 and abs(reached["b"] - 0.1) < 0.04
