"""Language ID: held-out accuracy, codewords, odd rows."""

import zlib

import numpy as np

from helixframe.llm import language_id as L
from helixframe.llm import queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op10_language_id(spark, sf).collect()
    assert {r.doc_id for r in got} == set(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and truth[r.doc_id].lang]
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in held]) > 0.97


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 6, 12, 40):
        code = L.codewords(n, 31)
        assert code.shape[0] == n and not (np.abs(code.sum(axis=0)) == n).any()
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (1 if n == 2 else 2 if n == 3 else 4)
    exhaustive = L.codewords(5, 31)
    assert exhaustive.shape[1] == 15 and len({tuple(c) for c in exhaustive.T}) == 15


def test_blocks_hold_each_n_gram_once():
    data = L.lowered("abc déf " * 50)
    for order in (2, 3, 4):
        parts = [L.buckets(p, order, 13) for p in L.block_slices(data, order, 17)]
        assert np.concatenate(parts).tolist() == L.buckets(data, order, 13).tolist()


ROWS = [(1, "the cat and the dog " * 5, "en"), (2, "der hund und die katze " * 5, "de"), (3, None, "de"), (4, "", None), (5, "12 !? ²", "en"),
        (6, "the the the and dog", None), (None, "und die katze", "xx"), (6, "the the the and dog", None), (7, "é", "fr")]


def test_odd_rows_and_models(spark):
    rows = spark.createDataFrame([(*r, "mine") for r in ROWS], "doc_id long, text string, lang string, score string")
    model = L.fit(rows.where("doc_id < 3"))
    assert model.languages == ("de", "en")
    got = L.predict(rows, model).collect()
    assert len(got) == len(ROWS)
    by = {(r.doc_id, r.text): r for r in got}
    for key in ((3, None), (4, ""), (5, "12 !? ²")):
        assert (by[key].lang_pred, by[key].score, by[key].ambiguous) == ("und", 0.0, True)
    assert by[6, "the the the and dog"].lang_pred == "en" and by[None, "und die katze"].lang_pred == "de"
    nothing = L.fit(rows.limit(0))
    assert {r.lang_pred for r in L.predict(rows, nothing).collect()} == {"und"}
    one = L.fit(rows.where("doc_id = 1"))
    assert {r.lang_pred for r in L.predict(rows.where("doc_id = 2"), one).collect()} == {"en"}
    assert L.predict(rows.limit(0), model).count() == 0
    ids = [(r[0], r[1]) for r in rows.select(L.learnable(rows.doc_id), L.held_out(rows.doc_id)).collect()]
    assert ids[6] == (False, False) and all(a != b for i, (a, b) in enumerate(ids) if i != 6)


def test_an_even_mixture_is_flagged():
    counts = {"a": np.zeros(3 << 13), "b": np.zeros(3 << 13)}
    for lang, text in (("a", "lorem ipsum " * 30), ("b", "foo bar qux " * 30)):
        for i, order in enumerate((2, 3, 4)):
            np.add.at(counts[lang], (i << 13) + L.buckets(L.lowered(text), order, 13), 1)
    model = L.model_of(counts, L.Settings())
    assert L.decode(*L.margins("lorem ipsum lorem", model), model)[0] == "a"
    assert L.decode(*L.margins("zzz", model), model)[2]
