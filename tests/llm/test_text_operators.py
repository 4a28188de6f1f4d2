"""Each operator on awkward documents against a plain computation or the tokenizer library itself."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barspark.llm import bpe_words, common, exact_dedup, langid, mixing, queries, shards, token_blocks, token_count

from .conftest import NORTH, SOUTH, edge_rows

ROWS = [(r[0], r[1]) for r in edge_rows()]
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(r):
    return tuple((v is None, str(v)) for v in r)


# --- exact duplicates -----------------------------------------------------------------------------


def groups_by_hand():
    found = defaultdict(list)
    for i, t in ROWS:
        found[(t or "").translate(A_Z)].append(i)
    out = []
    for t, ids in found.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=key)


@pytest.mark.parametrize("digest_chars", [64, 1])
def test_duplicate_groups(edge, digest_chars):
    out = exact_dedup.duplicate_groups(edge.repartition(5), salts=3, digest_chars=digest_chars)
    got = sorted((tuple(r) for r in out.collect()), key=key)
    want = [(*w[:4], w[4][:digest_chars]) for w in groups_by_hand()]
    assert got == sorted(want, key=key)


def test_drop_duplicates_keeps_one_row_a_text(edge, nothing):
    out = exact_dedup.drop_duplicates(edge.repartition(7), salts=3)
    assert out.columns == edge.columns
    got = sorted(((r.doc_id, r.text) for r in out.select("doc_id", "text").collect()), key=key)
    want = sorted(((i, t) for i, t in {(g[1], g[4]) for g in groups_by_hand()}), key=key)
    assert sorted(((i, hashlib.sha256((t or "").translate(A_Z).encode()).hexdigest()) for i, t in got), key=key) == want
    assert exact_dedup.drop_duplicates(nothing).count() == 0 and exact_dedup.duplicate_groups(nothing).count() == 0


def test_hot_text_over_many_partitions(spark):
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("Hot text")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    out = exact_dedup.duplicate_groups(rows.repartition(16), salts=4)
    assert out.filter("kept").count() == 20_001
    hot = out.filter("group_size > 1").agg(F.count("*"), F.min("keep_id"), F.max("keep_id")).first()
    assert tuple(hot) == (10_000, 29_997, 29_997)
    assert exact_dedup.drop_duplicates(rows).count() == 20_001


# --- shards -----------------------------------------------------------------------------------------


@given(st.integers(1, 3000), st.integers(0, 10))
@settings(max_examples=60, deadline=None)
def test_permutation_is_a_bijection(n, seed):
    p = shards.Permutation(n, seed)
    rows = np.arange(n)
    out = p.forward(rows)
    assert sorted(out.tolist()) == rows.tolist()
    assert (p.inverse(out) == rows).all()


def test_permutation_of_large_numbers_and_seeds():
    n = 10**13 + 7
    rows = np.random.default_rng(0).integers(0, n, 1000)
    p = shards.Permutation(n, 3)
    out = p.forward(rows)
    assert ((out >= 0) & (out < n)).all() and (p.inverse(out) == rows).all()
    assert (out != shards.Permutation(n, 4).forward(rows)).any()
    shard, slot = shards.slot_of(rows, n, 40, 3)
    assert (shards.row_at(shard, slot, n, 40, 3) == rows).all()


def test_permutation_mixes():
    out = shards.Permutation(20_000, 1).forward(np.arange(20_000))
    assert abs(np.corrcoef(np.arange(20_000), out)[0, 1]) < 0.03
    assert (np.diff(out) == 1).mean() < 0.01


def test_assign_shards_is_even_gapless_and_blind_to_layout(edge, nothing):
    narrow = edge.select("doc_id", "text", "shard", "slot", "row_no")
    one = shards.assign_shards(narrow, ["doc_id"], 7, 5)
    rows = one.collect()
    assert one.columns == ["doc_id", "text", "row_no", "shard", "slot"] and len(rows) == len(ROWS)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    two = shards.assign_shards(narrow.repartition(9, "text"), ["doc_id"], 7, 5).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, two))
    assert shards.assign_shards(nothing.select("doc_id"), ["doc_id"], 7).count() == 0


# --- tokenizers ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(public_tokenizers.path(queries.BYTES))


def test_bpe_words_equal_the_library(edge, nothing, byte_bpe):
    load = lambda: bpe_words.Codec(public_tokenizers.path(queries.BYTES))
    out = bpe_words.encode_decode(edge.repartition(3), load, "test").collect()
    want = []
    for i, t in ROWS:
        ids = byte_bpe.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, byte_bpe.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.id, r.ids, r.decoded) for r in out), key=key) == sorted(want, key=key)
    assert bpe_words.encode_decode(nothing, load, "test").count() == 0


def test_bpe_blocks_are_cut_between_documents(edge, byte_bpe, monkeypatch):
    monkeypatch.setattr(bpe_words, "BLOCK_BYTES", 500)
    monkeypatch.setattr(bpe_words, "GROUP_WORDS", 7)
    load = lambda: bpe_words.Codec(public_tokenizers.path(queries.BYTES))
    out = bpe_words.encode_decode(edge, load, "test").collect()
    got = sorted(((r.id, len(r.ids)) for r in out), key=key)
    assert got == sorted(((i, len(byte_bpe.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS), key=key)


PIECES_OF_TEXT = st.lists(st.sampled_from(["a", "b", " ", "  ", "\n", "\t", "\r", "'s", "'", "ré", "1", "½", "中", "\x1c", "\x85", "\xa0", "　", "!", ".", "<|endoftext|>", "😀", "\x00"]), max_size=12)


@given(PIECES_OF_TEXT)
@settings(max_examples=400, deadline=None)
def test_words_encode_apart(parts):
    text = "".join(parts)
    codec = common_codec()
    words = bpe_words.split_words(text)
    assert "".join(words) == text
    ids = [i for w in codec.encode(words) for i in np.frombuffer(w, "<u4").tolist()]
    assert ids == codec.tok.encode(text, add_special_tokens=False).ids
    assert codec.decode(np.array(ids, np.int64)) == text.encode()


_KEPT: list = []


def common_codec():
    if not _KEPT:
        _KEPT.append(bpe_words.Codec(public_tokenizers.path(queries.BYTES)))
    return _KEPT[0]


def test_token_counts_equal_the_library(edge, nothing):
    path = public_tokenizers.path(queries.PIECES)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = token_count.count_tokens(edge, lambda: token_count.load_pieces(path), "test")
    want = [(i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in ROWS]
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted(want, key=key)
    assert token_count.count_tokens(nothing, lambda: token_count.load_pieces(path), "test").count() == 0


@pytest.fixture(scope="module")
def merger():
    return token_count.PieceMerger(token_count.load_pieces(public_tokenizers.path(queries.PIECES)))


def test_merging_rounds_and_heap_agree_with_the_library(merger):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    rng = np.random.default_rng(2)
    chars = list("aaabcdehinorst  \n\t▁.,<>/s=01é😀中\x00")
    texts = ["".join(rng.choice(chars, rng.integers(1, 80))) for _ in range(800)] + ["=" * 700, "ab" * 600, "a" * 3000, "", " ", "▁ ▁"]
    got = token_count.count_texts(texts, merger, merger.table)
    assert got.tolist() == [len(sp.encode(t)) for t in texts]


def test_word_table_is_bounded_and_right():
    table = common.WordTable(lambda words: [w.upper() for w in words], limit=3)
    for words in (["a", "b", "a"], ["c", "d"], ["e", "a"], ["a", "f"]):
        assert table.get(words) == [w.upper() for w in words]
    assert len(table.index) <= 5
    numbers = common.NumberTable(lambda words: np.array([len(w) for w in words]), limit=2)
    for words in (["a", "bb"], ["ccc"], ["dddd", "a"], ["bb"]):
        rows = numbers.rows(words)
        assert numbers.matrix[rows].tolist() == [len(w) for w in words]


# --- packed blocks --------------------------------------------------------------------------------------


@given(st.integers(1, 32), st.integers(1, 9), st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=20), max_size=6))
@settings(max_examples=200, deadline=None)
def test_block_files_round_trip(bits, block, docs):
    rows = [np.array([v % (1 << bits) for v in d], np.uint32) for d in docs]
    f = token_blocks.BlockFile(token_blocks.write_file(rows, bits, block))
    assert [f.document(i).tolist() for i in range(f.n_docs)] == [r.tolist() for r in rows]
    flat = [v for r in rows for v in r.tolist()]
    for a in range(len(flat)):
        assert f.ids(a, min(len(flat), a + 3)).tolist() == flat[a : a + 3]


WORDS_OF_TEXT = st.lists(st.sampled_from(["The", "it's", "'s", "É", "ß.", "naïve", "!!", "a.b", "x,", "ＡＢ", "½", "don't.", "''", "<|startoftext|>", "4.0", "#tag", "w|", "İ"]), max_size=10)


@given(WORDS_OF_TEXT, st.sampled_from([" ", "  ", "\n"]))
@settings(max_examples=200, deadline=None)
def test_word_encoder_equals_the_library_on_whole_texts(words, gap):
    encode = word_encoder()
    text = gap.join(words)
    got = b"".join(encode(text.replace("\n", " ").split(" ")))
    assert np.frombuffer(got, "<u4").tolist() == encode.tok.encode(text, add_special_tokens=False).ids


_WORDS: list = []


def word_encoder():
    if not _WORDS:
        _WORDS.append(queries._word_tokenizer())
    return _WORDS[0]


def test_packed_width_and_limits():
    assert [token_blocks.bits_for(v) for v in (1, 2, 3, 256, 257, 49_408)] == [1, 1, 2, 8, 9, 16]
    with pytest.raises(ValueError):
        token_blocks.write_file([np.array([8], np.uint32)], 3)
    assert len(token_blocks.pack_bits(np.arange(100, dtype=np.uint32), 7)) == 88


@pytest.mark.parametrize("size", [queries.WORD_VOCABULARY, 100_000])
def test_token_blocks_in_id_order(edge, nothing, size):
    tok = Tokenizer.from_file(public_tokenizers.path(queries.WORDS))
    encoded = token_blocks.encode_documents(edge, queries._word_tokenizer, "test words", size, 2)
    out = token_blocks.read_blocks(token_blocks.write_blocks(encoded, size, file_ids=300)).collect()
    docs = [(i, np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")) for i, t in ROWS]
    assert Counter((r.id, r.n, r.ids_crc32) for r in out) == Counter((i, d.size, zlib.crc32(d.tobytes())) for i, d in docs)
    order = sorted(out, key=lambda r: r.start)
    ids = [r.id for r in order]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert [r.start for r in order] == np.cumsum([0, *[r.n for r in order]])[:-1].tolist()
    empty = token_blocks.encode_documents(nothing, queries._word_tokenizer, "test words", size, 2)
    assert token_blocks.read_blocks(token_blocks.write_blocks(empty, size)).count() == 0


# --- language ID --------------------------------------------------------------------------------------------


def test_language_id(edge, nothing, spark):
    models = langid.fit(edge, sample=15)
    assert models.languages == ["no", "so"]
    rows = langid.predict(edge, models).collect()
    assert len(rows) == len(ROWS)
    text = {i: t for i, t in ROWS}
    for r in rows:
        assert 0 <= r.score <= 1
        if r.id is not None and r.id < 40:
            assert r.lang_pred == ("no" if r.id % 2 == 0 else "so") and not r.rejected
        if not any(c.isalpha() for c in text.get(r.id) or ""):
            assert (r.lang_pred, r.score, r.cross_entropy, r.rejected) == ("und", 0.0, None, True)
    kept = langid.drop_rejected(edge, models)
    assert kept.columns == edge.columns
    ids = {r.doc_id for r in kept.collect()}
    assert set(range(40)) <= ids and not ids & {100, 101, 102, 103}
    foreign = spark.createDataFrame([(1, "ξενη γλωσσα που δεν ξερουμε " * 20)], "doc_id bigint, text string")
    assert langid.predict(foreign, models).first().rejected
    blank = langid.fit(nothing)
    assert blank.languages == []
    assert {r.lang_pred for r in langid.predict(edge, blank).collect()} == {"und"}
    assert langid.predict(nothing, models).count() == 0


def test_character_model_is_a_distribution():
    words = ["aba", "abb", "bab", "aa", "cab"]
    model = langid.CharModel.fit(words, np.array([5.0, 2, 2, 1, 1]), order=4)
    letters = "abc "
    for context in ("", "a", "ab", "ca", "cc"):
        given = prefix(model, context)
        known = sum(np.exp(prefix(model, context + c) - given) for c in letters)
        unseen = np.exp(prefix(model, context + "z") - given)  # each other character's share
        assert known + unseen * (langid.ALPHABET - len(letters)) == pytest.approx(1)


def test_merged_arrays_score_like_each_model():
    one = langid.CharModel.fit(["aba", "abb", "bab", "aa", "cab"], np.array([5.0, 2, 2, 1, 1]))
    two = langid.CharModel.fit(["xyz", "xay", "zz"], np.array([1.0, 4, 2]))
    words = ["aba", "xyzzy", "q", "", "abxy", "ccc"]
    got = langid.MergedModels([one, two], langid.ORDER).score(words)
    assert got == pytest.approx(np.column_stack([one.score(words), two.score(words)]))


def prefix(model, chars: str) -> float:
    """Log probability that a word starts with ``chars`` (a space ends the word)."""
    if not chars:
        return 0.0
    word = chars.rstrip(" ")
    whole = model.score([word])[0]
    if chars.endswith(" "):
        return whole
    rows, _ = langid._grams([word], 4)
    before = langid._contexts([word], 4)
    logp = np.full(rows.shape[1], -np.log(langid.ALPHABET))
    for k in range(4):
        ctx = before[k - 1] if k else np.full(rows.shape[1], np.uint64(1))
        known, at = langid._find(model.grams[k], rows[k])
        seen, cat = langid._find(model.contexts[k], ctx)
        logp = np.where(known, model.logp[k][at], np.where(seen, logp + model.backoff[k][cat], logp))
    return float(logp[:-1].sum())


def plain_word(counts: dict[str, int], order: int, word: str) -> float:
    """Log probability of a word by interpolated Kneser-Ney over dictionaries of strings, straight from the definition."""
    grams: list[dict[str, float]] = [{} for _ in range(order)]
    for w, n in counts.items():
        s = f" {w} "
        for i in range(1, len(s)):
            for k in range(min(i, order - 1) + 1):
                grams[k][s[i - k : i + 1]] = grams[k].get(s[i - k : i + 1], 0) + n
    told = []
    for k in range(order):
        lefts: dict[str, set] = {}
        for g in grams[k + 1] if k + 1 < order else ():
            lefts.setdefault(g[1:], set()).add(g[0])
        told.append({g: len(lefts[g]) if g in lefts else n for g, n in grams[k].items()})

    def p(context: str, char: str) -> float:
        k = len(context)
        shorter = p(context[1:], char) if k else 1 / langid.ALPHABET
        mates = {g: n for g, n in told[k].items() if g[:-1] == context}
        if not mates:
            return shorter
        ones, twos = (sum(n == x for n in told[k].values()) for x in (1, 2))
        discount = (min(ones / (ones + 2 * twos), 0.95) if ones + twos else 0.5) or 0.5
        cut = {g: min(discount, 0.95 * n) for g, n in mates.items()}
        g, total = context + char, sum(mates.values())
        return (mates.get(g, 0) - cut.get(g, 0)) / total + sum(cut.values()) / total * shorter

    s = f" {word} "
    return sum(np.log(p(s[max(0, i - order + 1) : i], s[i])) for i in range(1, len(s)))


def test_cross_entropies_equal_a_plain_kneser_ney(spark):
    rng = random.Random(3)
    learnt = {"a": {}, "b": {}}
    for lang, syllables in (("a", NORTH), ("b", SOUTH)):
        for _ in range(120):
            w = "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
            learnt[lang][w] = learnt[lang].get(w, 0) + rng.randint(1, 3)
    models = [langid.CharModel.fit(list(c), np.array(list(c.values()), np.float64)) for c in learnt.values()]
    texts = [" ".join(rng.choice(list(learnt[x])) for _ in range(4)) + y for x, y in zip("abab", (" thque", " zebra", "", " ció"))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = langid.predict(frame, langid.LanguageModels(["a", "b"], models, np.array([[2.0, 0.0], [2.0, 0.0]]))).collect()
    for r in got:
        words = texts[r.id].split()
        length = sum(len(w) + 1 for w in words)
        cross = [-sum(plain_word(c, langid.ORDER, w) for w in words) / length for c in learnt.values()]
        assert r.cross_entropy == pytest.approx(min(cross), rel=1e-9)
        assert r.lang_pred == "ab"[int(np.argmin(cross))] and r.rejected == (min(cross) > 2.0)
        assert r.score == pytest.approx(1 / sum(np.exp(-10 * (x - min(cross))) for x in cross))


def test_the_draw_is_the_smallest_hashes_whatever_the_limit(spark):
    ids = [(f"{i}", "many") for i in range(3000)] + [(f"{i}", "few") for i in range(30)] + [("same", "hot")] * 2000 + [(f"{i}", "hot") for i in range(200)]
    keyed = spark.createDataFrame(ids, "id string, lang string").select("lang", "id", F.xxhash64("id").alias("h"), F.crc32(F.encode("id", "utf-8")).alias("c")).repartition(6)
    rows = {"many": 3000, "few": 30, "hot": 2200}
    every = sorted((r.lang, r.h, r.id) for r in keyed.collect())
    want = [x for lang in rows for x in [r for r in every if r[0] == lang][:50]]
    for margin in (4, 0.2):  # the second lets too few rows through, so all languages are drawn again
        assert sorted((r.lang, r.h, r.id) for r in langid._drawn(keyed, rows, 50, margin).collect()) == sorted(want)


def test_bounds_of_the_language_models_are_errors(edge, monkeypatch):
    with pytest.raises(ValueError, match="max_sample_bytes"):
        langid.fit(edge, sample=15, max_sample_bytes=1000)
    with pytest.raises(ValueError, match="max_model_bytes"):
        langid.fit(edge, sample=15, max_model_bytes=1000)
    monkeypatch.setattr(langid, "MAX_LABELS", 1)
    with pytest.raises(ValueError, match="labels"):
        langid.fit(edge, sample=15)


def test_held_out_accuracy_on_documents(spark):
    out = queries.op1_kneser_ney_langid(spark, "/root/testdata/sf0.001")
    truth = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    got = out.join(truth, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.max("rejected")).first()
    assert got[0] > 0.95
    assert out.count() == truth.count()


# --- mixing -----------------------------------------------------------------------------------------------------


def test_raking_meets_margins():
    rng = np.random.default_rng(1)
    cells = [(a, b, c) for a in "xyz" for b in "pq" for c in "mn"]
    tokens = rng.integers(10, 1000, len(cells))
    targets = [{"x": 0.5, "y": 0.3, "z": 0.2}, {"p": 0.6, "q": 0.4}, {"m": 0.5, "n": 0.5}]
    raked = mixing.rake(cells, tokens, targets)
    weight = raked.tokens * raked.scale / (raked.tokens * raked.scale).sum()
    for d, target in enumerate(targets):
        for name, share in target.items():
            assert sum(w for w, c in zip(weight, cells) if c[d] == name) == pytest.approx(share, abs=1e-8)
    assert raked.error <= mixing.TOLERANCE
    p = raked.probability(0.0)
    assert p.max() == pytest.approx(1) and (np.argsort(p) == np.argsort(raked.scale)).all()


def test_rare_category_does_not_thin_out_the_rest():
    raked = mixing.rake([("a",), ("b",), ("rare",)], np.array([1000.0, 1000, 1]), [{"a": 0.48, "b": 0.48, "rare": 0.04}])
    p = dict(zip("abr", raked.probability().tolist()))
    assert p["r"] == 1 and p["a"] == p["b"] == pytest.approx(1)


def test_mix_covers_awkward_rows(edge, nothing):
    targets = {"source": {"src0": 0.4, "src1": 0.3, "src2": 0.2}, "lang": {"no": 0.5, "so": 0.4}, "topic": {"terse": 0.5}}
    out = mixing.mix(edge, targets)
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.probability <= 1 for r in rows)
    assert {r.source for r in rows} == {"src0", "src1", "src2", "*"}
    kept = mixing.sample(edge, targets)
    assert kept.columns == edge.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(str(r.id) for r in rows if r.kept)
    again = mixing.sample(edge.repartition(5), targets)
    assert sorted(str(r.doc_id) for r in again.collect()) == sorted(str(r.doc_id) for r in kept.collect())
    assert mixing.mix(nothing, targets).count() == 0 and mixing.sample(nothing, targets).count() == 0
    with pytest.raises(ValueError):
        mixing.target_shares({"a": 0.7, "b": 0.6})


def test_topics_by_hand(edge):
    def topic(t):
        n = len(t or "")
        if not n:
            return "plain"
        counts = [(t.count(","), 10), (t.count("."), 15), (t.count("\n"), 3)]
        return next((name for name, (c, least) in zip(mixing.TOPICS, counts) if c * 1000 >= least * n), "plain")

    got = edge.select("text", mixing.topic_of(F.col("text")).alias("topic"), mixing.tokens_of(F.col("text")).alias("tokens")).collect()
    assert all(r.topic == topic(r.text) and r.tokens == -(-len((r.text or "").encode()) // 4) for r in got)


def test_probabilities_are_kept_in_the_long_run(spark):
    rows = spark.range(40_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("some plain text "), "id").alias("text"), F.lit("en").alias("lang"), F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("source")
    )
    out = mixing.sample(rows, {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 1.0}})
    share = out.agg(F.avg((F.col("source") == "a").cast("double"))).first()[0]
    assert share == pytest.approx(0.5, abs=0.02)


def skewed(spark):
    """A table with a third of the rows in src0 and a rare src1, in four languages and topics."""
    topic = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4))
    text = F.when(topic == 0, "one, two, three, four").when(topic == 1, "One. Two. Three four").when(topic == 2, "one two\nthree\nfour").otherwise("one two three four")
    u = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000))
    source = F.when(u < 340, "src0").when(u < 342, "src1").otherwise(F.concat(F.lit("src"), 2 + u % 18))
    lang = F.element_at(F.array(*map(F.lit, ["en", "de", "fr", "es"])), (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(4)) + 1).cast("int"))
    return spark.range(40_000).select(F.col("id").alias("doc_id"), text.alias("text"), source.alias("source"), lang.alias("lang"))


def test_rare_source_keeps_its_target_at_the_production_trim(spark):
    docs = skewed(spark)
    out = mixing.mix(docs, queries.MIX)
    expected = F.sum(F.col("tokens") * F.col("probability"))
    for dimension in mixing.DIMENSIONS:
        got = {r[0]: r[1] for r in out.groupBy(dimension).agg(expected.alias("n")).collect()}
        named = {k: v / sum(queries.MIX[dimension].values()) for k, v in queries.MIX[dimension].items()}
        assert all(got[k] / sum(got.values()) >= (1 - mixing.SHORT) * v for k, v in named.items()), (dimension, got)
    told = {(r.dimension, r.category): r for r in mixing.margins(docs, queries.MIX).collect()}
    rare = told["source", "src1"]
    assert rare.target == 0.0495 and rare.held < 0.005 and 0.95 * 0.05 <= rare.reached <= 0.05 and rare.error <= mixing.TOLERANCE


def test_least_rate_is_exact_and_leaves_given_rates_alone():
    rng = np.random.default_rng(4)
    for _ in range(20):
        tokens, scale, short = rng.integers(1, 99, 7).astype(float), rng.random(7), rng.random() / 2
        rate = mixing._least_rate(tokens, scale, short)
        assert (tokens * np.minimum(rate, scale)).sum() == pytest.approx((1 - short) * (tokens * scale).sum())
    cells, tokens = [(a, b) for a in "xy" for b in "pq"], np.array([90.0, 100, 110, 100])
    raked = mixing.rake(cells, tokens, [{"x": 0.5, "y": 0.5}, {"p": 0.5, "q": 0.5}])
    assert (raked.probability(0.0) == raked.probability(0.0, mixing.SHORT)).all()


def test_missed_targets_are_reported(spark, caplog):
    rows = spark.createDataFrame([(1, "some text", "a", "en"), (2, "more text", "b", "de")], "doc_id int, text string, source string, lang string")
    with caplog.at_level("WARNING"):
        mixing.mix(rows, {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.1, "de": 0.9}})
    assert "margins off by" in caplog.text and "target 0.9000" in caplog.text
    caplog.clear()
    with caplog.at_level("WARNING"):
        mixing.sample(rows, {"source": {"a": 0.5, "gone": 0.5}, "lang": {"en": 0.5, "de": 0.5}})
    assert "'gone': target 0.5000" in caplog.text


def test_mix_rakes_given_token_counts(spark):
    count = F.when(F.col("lang") == "es", 9).when(F.col("lang") == "de", 5).otherwise(4)
    docs = skewed(spark).withColumn("n_tokens", count)
    out = mixing.mix(docs, queries.MIX, tokens="n_tokens")
    got = {r.lang: r.n for r in out.groupBy("lang").agg(F.sum(F.col("tokens") * F.col("probability")).alias("n")).collect()}
    assert out.filter("tokens not in (4, 5, 9)").count() == 0
    for lang, share in queries.MIX["lang"].items():
        assert got[lang] / sum(got.values()) == pytest.approx(share / 0.99, rel=0.06), lang
    kept = mixing.sample(docs, queries.MIX, tokens="n_tokens")
    assert kept.columns == docs.columns and kept.count() == out.filter("kept").count()
    told = {r.category: r.reached for r in mixing.margins(docs, queries.MIX, tokens="n_tokens").filter("dimension = 'lang'").collect()}
    assert all(told[k] == pytest.approx(v / sum(got.values())) for k, v in got.items())


def test_labels_beyond_the_bound_are_reported(spark, caplog):
    rows = [(i, f"word{'abc'[i % 3]} other words", lang) for i, lang in enumerate(["en"] * 6 + ["de"] * 5 + ["fr"] * 2 + ["es"])]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    with caplog.at_level("WARNING"):
        assert langid.fit(docs, sample=5, max_languages=4).languages == ["de", "en", "es", "fr"]
    assert not caplog.text
    with caplog.at_level("WARNING"):
        assert langid.fit(docs, sample=5, max_languages=2).languages == ["de", "en"]
    assert "2 labels ('fr' first) on 3 rows are not learnt" in caplog.text
