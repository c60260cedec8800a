"""Operators with Python workers against exact counts, brute force, the library and held-out labels."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import public_tokenizers
from conftest import SF_CHECK
from staysense.llm import bpe_tree, byte_gru, ngram_bloom, simhash_mih
from staysense.llm.queries import QUERIES
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_CHECK}/documents.parquet")


# ------------------------------------------------------------------------ op5
@pytest.mark.parametrize("model", [ngram_bloom.BloomModel(), ngram_bloom.BloomModel(shard_tokens=20_000, block_mb=0.05)])
def test_bloom_scores(documents, model, monkeypatch):
    monkeypatch.setattr(ngram_bloom, "HEAD", 1000)          # so that many words take the join
    src = documents.select("doc_id", "text").toPandas()
    tokens = {d: [*WORD.findall(t.translate(LOWER)), None] for d, t in zip(src.doc_id, src.text)}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in tokens}
    c = Counter(w for d, t in tokens.items() if not held[d] for w in t)
    n, v = sum(c.values()), len(c)
    rows = ngram_bloom.score(documents, model=model).collect()
    assert len(rows) == len(tokens)
    for r in rows:
        t = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), rel_tol=1e-9)
        assert r.score <= 0
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)      # pairs tell more than words


def test_bloom_levels_are_never_low_and_rarely_high(spark):
    rnd = random.Random(4)
    grams = {rnd.getrandbits(63): 1 + int(rnd.paretovariate(0.7)) for _ in range(20_000)}
    model = ngram_bloom.BloomModel()
    h, n = np.array(list(grams), np.uint64), np.array(list(grams.values()))
    level = 1 + np.floor(np.log2(n) + 1e-9).astype(int)
    bits = int(level.sum() * model.probes / np.log(2)) // 64 * 64 + 128
    data = np.zeros(bits // 8, np.uint8)
    for q in range(1, level.max() + 1):
        p = ngram_bloom._places(h[level >= q], q, np.uint64(bits), model.probes)
        np.bitwise_or.at(data, (p >> np.uint64(3)).astype(int).ravel(), (1 << (p & np.uint64(7))).astype(np.uint8).ravel())
    block = ngram_bloom._Block(1, 0, 1, [{"shard": 0, "bits": bits, "data": data.tobytes()}], model)
    got = block.levels(h).astype(int)
    assert (got >= level).all() and (got > level).mean() < 0.06
    others = np.array([rnd.getrandbits(63) for _ in range(20_000)], np.uint64)
    assert (block.levels(others) > 0).mean() < 0.06


# ------------------------------------------------------------------------ op6
def simhash(text):
    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def reachable(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints(documents):
    src = dict(documents.select("doc_id", "text").collect())
    rows = {r.doc_id: r for r in simhash_mih.fingerprints(documents).collect()}
    for d in sorted(src)[:250]:
        assert simhash(src[d]) == rows[d].fp % 2 ** 64
    assert simhash_mih._fingerprint("a" * 9 + " b", 3, 42) == simhash("a" * 9 + " b")


@pytest.mark.parametrize("cap", [2, 64])
def test_components_match_brute_force(spark, cap):
    """Random fingerprints, chains, and a crowd that shares a segment; a small cap sends it the other way."""
    rnd = random.Random(cap)
    fps = [rnd.getrandbits(64) for _ in range(40)]
    for _ in range(160):
        x = rnd.choice(fps)
        for _ in range(rnd.randint(0, 3)):
            x ^= 1 << rnd.randrange(64)
        fps.append(x)
    crowd = rnd.getrandbits(64)
    fps += [crowd ^ sum(1 << b for b in rnd.sample(range(32), 3)) for _ in range(80)] + [0, 0, 1 << 63, 3 << 62]
    ids = rnd.sample(range(10_000), len(fps))
    order = sorted(range(len(fps)), key=lambda i: ids[i])
    want = dict(zip([ids[i] for i in order], [ids[order[r]] for r in reachable([fps[i] for i in order])]))
    df = spark.createDataFrame([(i, f - 2 ** 64 if f >= 2 ** 63 else f) for i, f in zip(ids, fps)], "doc_id long, fp long")
    distinct = df.groupBy("fp").agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "node")
    pairs = simhash_mih.links(distinct.select("fp"), bucket_cap=cap)
    node = dict(distinct.select("fp", "node").collect())
    edges = [(node[r.a], node[r.b]) for r in pairs.collect()]
    roots = {}
    if edges:
        roots = dict(simhash_mih.components(spark.createDataFrame(edges, "a long, b long")).collect())
    for i, f in df.collect():
        assert roots.get(node[f], node[f]) == want[i]


def test_group_and_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (3, text.upper()), (9, None), (8, " "), (1, "quite another text " * 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash_mih.group(df).collect()} == {5: 3, 3: 3, 9: 8, 8: 8, 1: 1}
    assert sorted(r.doc_id for r in simhash_mih.keep_one(df).collect()) == [1, 3, 8]


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(400)], "a long, b long")
    assert {r.root for r in simhash_mih.components(edges).collect()} == {0}


# ------------------------------------------------------------------------ op7
def test_language_held_out_accuracy(spark, documents):
    lang = dict(documents.select("doc_id", "lang").collect())
    rows = [r for r in QUERIES["op7_byte_gru"](spark, SF_CHECK).collect() if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows]) > 0.95


def test_gradients_match_differences():
    plan = byte_gru.GruPlan(hidden=3)
    net = byte_gru.ByteGru(3, plan)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rng = np.random.default_rng(0)
    x, label = rng.integers(97, 105, (6, 4)).astype(np.int16), np.array([0, 1, 2, 1])
    x[4:, 1] = byte_gru.PAD
    weight = (x != byte_gru.PAD).astype(float)
    scan = net._scan
    net._scan = lambda a, d, keep: _double(scan, net, a, d, keep)
    _, g = net.gradients(x, label, weight)
    for k in net.w:
        flat, where = net.w[k].reshape(-1), rng.integers(0, net.w[k].size, 6)
        if k[0] == "x":
            where = (x[rng.integers(0, 4, 6), rng.integers(0, 4, 6)].astype(int)) * 9 + rng.integers(0, 9, 6)
        for i in where:
            old, e = flat[i], 1e-5
            flat[i] = old + e
            up = net.gradients(x, label, weight)[0]
            flat[i] = old - e
            down = net.gradients(x, label, weight)[0]
            flat[i] = old
            assert abs((up - down) / (2 * e) - g[k].reshape(-1)[i]) < 2e-4


def _double(scan, net, a, d, keep):
    return scan(a, d, keep)


def test_windows_of_a_text_cover_it_once():
    plan = byte_gru.GruPlan(step=10, margin=3, block=4)
    net = byte_gru.ByteGru(4, plan)
    texts = [b"", b"a", b"x" * 9, b"y" * 10, b"z" * 11, b"hello world " * 30]
    sums = byte_gru._document_sums(net, texts, plan)
    assert np.allclose(sums.sum(axis=1), [len(t) for t in texts], atol=1e-3)


# ------------------------------------------------------------------------ op9
def test_bpe_matches_library(spark):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rnd = random.Random(1)
    texts = [None, "", "  \n", " a b  c", "don't I'LL we've!!'s", "<|endoftext|>x<|startoftext|> <|endof text|>", "éá" * 3000,
             "ΑΣΣ Straße İI", "日本語" * 5000, "!?" * 300 + "'s'll", "a" * 70_000, "x" * 9000 + "<|endoftext|>" + "th" * 9000 + "12'sfoo",
             "".join(rnd.choice("abcdefgh") for _ in range(60_000)) + " tail"]
    texts += ["".join(rnd.choice("ab c'!<|>é́ \x1c\x85日Σ1\n") for _ in range(rnd.randint(0, 200))) for _ in range(200)]
    texts += ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(30, 300))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    for r in bpe_tree.encode_decode(df, bpe_tree.read_spec()).collect():
        ids = lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        assert bytes(r.ids) == np.array(ids, "<u4").tobytes() and r.n_tokens == len(ids) and r.decoded == text
        assert r.ids_sha256 == hashlib.sha256(bytes(r.ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("leaf", [1, 2, 5, 32])
def test_tree_joins_equal_direct_merging(leaf):
    import json
    tree = bpe_tree.Tree(json.loads(bpe_tree.read_spec()), leaf)
    rnd = random.Random(leaf)
    for _ in range(300):
        s = "".join(rnd.choice("thesandingrou") for _ in range(rnd.randint(1, 60)))
        assert tree.run(s) == tree.direct(s, True)


def test_bpe_query(spark, documents):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    src = dict(documents.select("doc_id", "text").collect())
    rows = QUERIES["op9_bpe_tree"](spark, SF_CHECK).collect()
    assert len(rows) == len(src)
    for r in rows[:200]:
        ids = lib.encode(src[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_simhash_keeps_one_row_of_repeated_and_null_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(1, a), (5, a + " "), (5, b), (None, c), (None, c + "  "), (None, c), (7, b + " "), (8, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text.strip()) for r in simhash_mih.keep_one(df).collect()]
    assert sorted(got, key=str) == sorted([(1, a), (5, b), (None, c)], key=str)


def test_packed_counts_take_as_few_bytes_as_the_largest_needs():
    import numpy as np
    from staysense.llm.ngram_bloom import _packed, _unpacked
    for counts, width in (([1, 255], 1), ([256, 1], 2), ([1, 2, 1 << 16], 4), ([1 << 32], 8)):
        data = _packed(np.array(counts, np.int64))
        assert len(data) == width * len(counts)
        assert _unpacked(data, len(counts)).tolist() == counts
