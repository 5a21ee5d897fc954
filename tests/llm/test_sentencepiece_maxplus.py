"""SentencePiece max-plus scan against a plain best path over whole texts, and exact round trips."""

import random
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from helixframe.llm import queries
from helixframe.llm import sentencepiece_maxplus as S

SF = "/root/testdata/sf0.001"
V = S.Vocabulary()
ODD = ["", " ", "a", "    " * 30, "a" * 300, "日本語 text" * 20, "x " * 150, "é😀\x00\n\t" * 30, "<s> </s> <unk> <0x41>", "no\u00a0break"]


def plain_score(text):
    """Best sum of piece scores over all paths through the whole text."""
    best = [0.0] + [-np.inf] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - V.width), j):
            s = V.score.get(text[i:j], V.unknown if i == j - 1 else None)
            if s is not None:
                best[j] = max(best[j], best[i] + s)
    return best[-1]


def score_of(ids):
    """Sum of scores; the bytes of a character without a piece count as one unknown."""
    pieces, data, total = {i: p for p, i in V.id.items()}, b"", 0.0
    for i in ids:
        if i in pieces:
            total += V.score[pieces[i]]
        else:
            data += V.bytes_of[i]
    return total + V.unknown * len(data.decode())


def texts():
    rng = random.Random(8)
    words = ["the", "tion", "ing", "und", "ß", "été", "zzxq", "  ", "\n", "日", "é", ",", "99"]
    return ODD + ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(60)) for _ in range(20)]


def ids_of(data):
    return np.frombuffer(data, np.uint32).tolist()


def test_whole_texts_take_the_best_path_and_read_back():
    for text in texts():
        ids = ids_of(V.encode(text))
        assert score_of(ids) == plain_score(S.normalised(text)), text
        assert V.decode(ids).decode() == (" " + text if text else "")


def test_any_cut_gives_the_same_score():
    for text in texts():
        value = S.normalised(text)
        for size in (1, 2, 7, 40):
            parts = [(value[a:a + size + V.width - 1], min(size, len(value) - a)) for a in range(0, len(value), size)]
            if not parts:
                continue
            matrices = [V.transfer(t, n) for t, n in parts]
            assert S.product(matrices)[0, 0] == plain_score(value), (text, size)
            at = S.states(matrices, 0, 0)
            ids = [x for (t, n), i, j in zip(parts, at, at[1:], strict=False) for x in ids_of(V.segment(t, n, i, j))]
            assert score_of(ids) == plain_score(value) and V.decode(ids).decode() == " " + text


def test_products_are_associative():
    rng = np.random.default_rng(0)
    m = [rng.integers(-50, 0, (6, 6)).astype(float) for _ in range(7)]
    left = m[0]
    for x in m[1:]:
        left = S.times(left, x)
    assert (S.product(m) == left).all()


def test_documents_in_chunks_and_blocks(spark):
    rows = list(enumerate(texts())) + [(7, None), (None, "null id " * 40), (3, ODD[3])]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_tokens int")
    for settings in (S.Settings(chunk=11, block=3), S.Settings()):
        out = S.decode_chunks(S.encode_documents(docs, settings=settings)).collect()
        by = {}
        for r in sorted(out, key=lambda r: r.chunk):
            by.setdefault((r.doc_id, r.n_chunks), []).append(r)
        assert sum(r.chunk == 0 for r in out) == len(rows)
        for i, t in set(rows) - {(7, None), (3, ODD[3]), (7, ODD[7])}:
            n = max(1, -(-len(S.normalised(t)) // settings.chunk))
            found = by[i, n]
            assert [r.chunk for r in found] == list(range(n))
            assert b"".join(r.utf8 for r in found).decode() == (" " + t if t else "")
            assert score_of([x for r in found for x in np.frombuffer(r.ids, "<u4").tolist()]) == plain_score(S.normalised(t))
            assert all(r.n_tokens == len(r.ids) // 4 for r in found)
    assert S.encode_documents(docs.limit(0)).count() == 0


def test_query_reads_back_every_document(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op6_sentencepiece(spark, SF, with_values=True).collect()
    assert any(r.n_chunks > 1 for r in rows)
    ids, decoded = {}, {}
    for r in rows:
        assert (r.ids_crc32, r.utf8_crc32, r.n_bytes) == (zlib.crc32(r.ids), zlib.crc32(r.utf8), len(r.utf8))
    for r in sorted(rows, key=lambda r: r.chunk):
        ids.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
        decoded[r.doc_id] = decoded.get(r.doc_id, b"") + r.utf8
    assert decoded == {i: S.normalised(t).encode() for i, t in docs.items()}
    # the ids are a path of the highest score through the whole text
    assert all(abs(score_of(ids[i]) - plain_score(S.normalised(t))) < 1e-6 for i, t in docs.items() if t)


def test_order_of_the_input_does_not_matter(spark):
    """Long texts, copies of them and of their ids, read in another order whenever the plan is evaluated."""
    text = "the words und so weiter " * 20
    rows = [(1, text), (1, text), (2, text), (2, text[5:]), (None, text), (3, "short")]
    docs = spark.createDataFrame(rows * 5, "doc_id long, text string").orderBy(F.rand())
    out = S.decode_chunks(S.encode_documents(docs, settings=S.Settings(chunk=31, block=2))).collect()
    for i, t in rows:
        n = -(-len(S.normalised(t)) // 31)
        chunks = [r for r in out if r.doc_id == i and r.n_chunks == n]
        wanted = 5 * sum(1 for k, u in rows if k == i and -(-len(S.normalised(u)) // 31) == n)
        for k in range(n):
            assert len([r for r in chunks if r.chunk == k]) == wanted


def test_batches_are_worked_on_in_slices():
    texts = ["abc", "", "x" * 50, "de", "f", "", "ghij"]
    batch = pd.DataFrame({"doc_id": range(7), "_text": texts}, index=range(5, 12))
    parts = list(S.sliced(iter([batch, batch.iloc[:0], batch]), "_text", 5))
    assert [x for p in parts for x in p["_text"]] == texts * 2 and [x for p in parts for x in p["doc_id"]] == [*range(7)] * 2
    assert all(len(p) == 1 or p["_text"].str.len().sum() <= 5 for p in parts) and max(map(len, parts)) > 1
