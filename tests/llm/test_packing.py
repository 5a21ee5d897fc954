"""Packing: every id once and in place, nothing padded, neighbours chosen by BM25."""

import math
import zlib
from collections import Counter

import numpy as np

from helixframe.llm import packing as P
from helixframe.llm import queries
from helixframe.llm import tokenizer as tk

SF = "/root/testdata/sf0.001"


def ids_of(text):
    return tk.load().encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(pieces, texts, window=2048):
    """``texts``: (doc_id, text) rows, ids unique."""
    want = {i: ids_of(t) for i, t in texts}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(want)
    for i, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(want[i])
            assert p.ids_crc32 == crc(want[i][at:at + p.length])
            at += p.length
        assert at == len(want[i])
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window and at & (at - 1) == 0


def test_query_places_every_id_once(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(queries.op7_packing(spark, SF).collect(), texts)


def test_odd_rows_and_small_shards(spark):
    texts = [(0, None), (1, ""), (2, "x"), (3, "long word " * 9000), (4, "a b c"), (5, "<|endoftext|> a  <|endoftext|>"), (None, "null id")]
    texts += [(i, f"text number {i} about {'cats' if i % 2 else 'dogs'} " * (i % 9)) for i in range(6, 120)]
    rows = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, length int")
    for size in (300, 1 << 20):
        pieces = P.digest(P.pack(rows, settings=P.Settings(shard_bytes=size))).collect()
        check([p for p in pieces if p.doc_id is not None] + [p for p in pieces if p.doc_id is None], texts)
    assert P.pack(rows.limit(0)).count() == 0
    twice = P.pack(rows.where("doc_id = 4").union(rows.where("doc_id = 4"))).collect()
    assert sum(p.length for p in twice) == 2 * len(ids_of("a b c"))


def plain_bm25(docs, seed, settings):
    n, mean = len(docs), np.mean([len(d) for d in docs])
    counts = [Counter(d.tolist()) for d in docs]
    df = Counter(t for c in counts for t in c)

    def weight(doc, term):
        tf = counts[doc][term]
        return math.log1p((n - df[term] + 0.5) / (df[term] + 0.5)) * tf * (settings.k1 + 1) / (
            tf + settings.k1 * (1 - settings.b + settings.b * len(docs[doc]) / mean))
    return [sum(weight(d, t) for t in counts[seed] if df[t] > 1 and counts[d][t]) for d in range(n)]


def test_neighbours_follow_bm25():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 60, rng.integers(3, 20)) for _ in range(40)]
    settings = P.Settings()
    index = P.Index(docs, settings)
    for seed in range(40):
        used = rng.random(40) < 0.3
        used[seed] = True
        score = plain_bm25(docs, seed, settings)
        got = index.neighbours(seed, used, 5)
        want = sorted((s for d, s in enumerate(score) if not used[d] and s > 0), reverse=True)[:5]
        assert not used[got].any() and np.allclose([score[d] for d in got], want, rtol=1e-4)


def test_windows_hold_related_documents():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 200, 300) + 1000 * (i % 4) for i in range(80)]
    order = rng.permutation(80)
    docs = [docs[i] for i in order]
    settings = P.Settings(window=1500)
    pieces = P.pack_shard([300] * 80, P.Index(docs, settings), settings)
    topics = {}
    for doc, _, _, sequence, _ in pieces:
        topics.setdefault(sequence, set()).add(int(order[doc] % 4))
    assert np.mean([len(t) == 1 for t in topics.values()]) > 0.8


def test_the_end_is_cut_into_powers_of_two():
    assert P.powers_of_two(1337) == [1024, 256, 32, 16, 8, 1] and P.powers_of_two(0) == []
    docs = [np.arange(5), np.arange(8)]
    settings = P.Settings(window=16)
    pieces = P.pack_shard([5, 8], P.Index(docs, settings), settings)
    sizes = Counter()
    for _, _, length, sequence, _ in pieces:
        sizes[sequence] += length
    assert sorted(sizes.values()) == [1, 4, 8]
    assert P.pack_shard([], P.Index([], settings), settings) == []


def recall_of_shards(spark, sf, settings, seeds=60, k=10):
    """The share of a seed's nearest documents in the whole corpus that its shard holds, where search is exact."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(texts)
    index = P.Index([np.array(ids_of(texts[i])) for i in ids], settings)
    pieces = P.pack(spark.read.parquet(f"{sf}/documents.parquet"), settings=settings).select("doc_id", "shard").distinct().collect()
    shard = {r.doc_id: r.shard for r in pieces}
    assert len(pieces) == len(ids)
    found, by_chance = [], np.mean([(np.array(list(shard.values())) == s).mean() for s in shard.values()])
    for seed in np.random.default_rng(0).choice(len(ids), seeds, replace=False):
        used = np.zeros(len(ids), bool)
        used[seed] = True
        found += [shard[ids[d]] == shard[ids[seed]] for d in index.neighbours(seed, used, k)]
    return np.mean(found), by_chance


def test_recall_of_neighbours_in_the_corpus(spark):
    whole, _ = recall_of_shards(spark, SF, P.Settings())
    assert whole == 1.0  # one shard: all terms of all documents
    routed, by_chance = recall_of_shards(spark, "/root/testdata/sf0.01", P.Settings(shard_bytes=1 << 19))
    assert routed > 2 * by_chance and by_chance < 0.4


def test_routes_keep_copies_together_and_fit_on_any_sample():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 64)).astype(np.float32)
    x[100:200] = x[0]
    routes = P.fit_routes(x, P.Settings())
    paths = routes.paths(x)
    assert len(set(paths[100:200])) == 1 and len(set(paths)) > 4
    for n in (0, 1, 40):
        same = np.repeat(x[:1], n, axis=0)
        assert set(P.fit_routes(same, P.Settings()).paths(x)) == {0}


def test_postings_of_placed_documents_are_forgotten(monkeypatch):
    """A seed does not read the postings of documents that were placed; what is left scores the same to the bit."""
    rng, settings = np.random.default_rng(5), P.Settings(window=64)
    docs = [rng.integers(2, 60, rng.integers(5, 50)) for _ in range(120)]
    index = P.Index(docs, settings)
    whole, used = P.Index(docs, settings), np.arange(120) % 3 == 0
    index.forget(used)
    assert not used[index.docs].any() and 0 < len(index.docs) < len(whole.docs)
    for seed in range(120):
        assert index.neighbours(seed, used, 20).tolist() == whole.neighbours(seed, used, 20).tolist()
    left = P.Index(docs, settings)
    pieces = P.pack_shard([len(d) for d in docs], left, settings)
    assert len(left.docs) < len(whole.docs) / 4
    monkeypatch.setattr(P.Index, "forget", lambda self, used: None)
    assert P.pack_shard([len(d) for d in docs], P.Index(docs, settings), settings) == pieces


def test_a_worker_gives_back_its_tokenizers():
    """Workers go on to other stages: what follows holds no pre-tokens or vocabulary, and makes them again if it must."""
    before = tk.worker_encoder().encode("some words, and more")
    tk.give_back()
    assert {held.cache_info().currsize for held in (tk.worker_encoder, tk.load, tk.special_strings)} == {0}
    assert tk.worker_encoder().encode("some words, and more") == before
