"""Token counts against the library itself."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from helixframe.llm import queries
from helixframe.llm import token_count as C
from helixframe.llm import tokenizer as tk

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "\n\n x", "a  b", "don't'll 'S", "<|endoftext|>", "a  <|endoftext|> b", "x\x1c y\x1d\x1e", "é́ ñ", "日本語 text",
       "٣٤ ⅷ²½", "😀😀 ok", " nbsp  two", "\u0558\u088f\u0c5c x", "tab\t\tx\r\n", "a" * 5000, " " * 3000, "𐂀 𞤀", "\x00\x01", "'s't"]
ALPHABET = st.sampled_from(list("ab Z0'’ \n\t\r\x0b\x1c\x85\u00a0éжß日٣²½_-.,#") + ["<|endoftext|>", "'ll", "  ", "\U0001f600", "\u2028"])
WHOLE = C.whole_tokens()


def library(text):
    return len(tk.load().encode(text or "", add_special_tokens=False).ids)


@given(st.lists(ALPHABET, max_size=40).map("".join))
@settings(max_examples=600, deadline=None)
def test_counts_and_ids_equal_the_library(text):
    n, direct = C.Counter(WHOLE).count(text)
    assert n == library(text) and direct <= n
    assert list(memoryview(tk.CachedEncoder().encode(text)).cast("I")) == tk.load().encode(text, add_special_tokens=False).ids


def test_every_agreed_character_is_cut_like_the_library_cuts_it():
    for c in range(0x524):
        text = f"a1 .{chr(c)}b2! {chr(c)}{chr(c)} \n{chr(c)}x"
        if not tk.ODD_BLANKS.search(text) and not tk.OTHER.search(text):
            found = tk.load().pre_tokenizer.pre_tokenize_str(text)
            assert tk.pre_tokens(text) == [text[a:b] for _, (a, b) in found], hex(c)


def test_random_code_points():
    rng = random.Random(5)
    counter = C.Counter(WHOLE)
    texts = ["".join(chr(rng.choice((rng.randrange(0x250), rng.randrange(0x3000), rng.randrange(0xE000, 0x110000)))) for _ in range(60))
             for _ in range(300)]
    assert [counter.count(t)[0] for t in texts] == [library(t) for t in texts]


def test_a_small_cache_changes_nothing():
    texts = [f"word{i} Some text {i}" for i in range(50)]
    counter, encoder = C.Counter(WHOLE, limit=3), tk.CachedEncoder(limit=3)
    for t in texts:
        assert counter.count(t)[0] == library(t) == len(encoder.encode(t)) // 4


def test_proven_strings_are_single_tokens():
    assert len(WHOLE) > 49_000 and "<|endoftext|>" not in WHOLE and " the" in WHOLE
    assert all(library(t) == 1 for t in random.Random(1).sample(sorted(WHOLE), 500))


def test_odd_rows(spark):
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate([None, *ODD, ODD[4]])], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in C.count_tokens(rows, limit=5).collect()}
    for i, t in enumerate([None, *ODD, ODD[4]]):
        assert (got[i].n_bytes, got[i].n_tokens) == (len((t or "").encode()), library(t)), t
        assert got[i].over_limit == (library(t) > 5)
    assert C.count_tokens(rows.limit(0)).count() == 0


def test_query_against_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op9_token_count(spark, SF).collect()}
    assert got == {i: (len((t or "").encode()), library(t), library(t) > 512) for i, t in texts.items()}
