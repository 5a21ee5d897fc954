"""SentencePiece encoding and decoding with a max-plus scan over chunks of giant documents.

The best segmentation of a text is the path of the highest score through its pieces. A long text is cut into
chunks. At the border after a chunk, all that matters of the path before it is how far its last piece reaches
over the border, so a chunk is a matrix: the best score from every state at its start to every state at its
end. Matrices combine associatively (sums along a path, the maximum over states), first in blocks of chunks,
then over blocks; from the combined ones follows the state at every border, and with it every chunk is
segmented again on its own. A task holds one chunk, or the matrices of a block.

The vocabulary and its scores come from a SentencePiece file; nothing is trained. Where no piece of the
vocabulary reaches from letters into a next word or into other characters, every path has a border there, so
words are segmented once and remembered.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby, islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.llm.common import written

PIECES = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"           # stands for a blank inside the pieces of the file
UNKNOWN_PENALTY = 10.0     # an unknown character scores this much below the worst piece
LOWEST = -np.inf


class Settings(NamedTuple):
    chunk: int = 16_384     # characters
    block: int = 64         # chunks whose matrices are combined at once
    cached: int = 450_000   # words that a worker remembers
    slice_chars: int = 1 << 20  # characters of a batch that are in work at once


class Remembered:
    """What ``compute`` gives for words. Two generations of half the limit each: a full one becomes the older
    one, whose entries move back when they are asked for, so frequent words are not computed again."""

    def __init__(self, compute: Callable, limit: int, longest: int = 64):
        self.compute, self.half, self.longest = compute, max(1, limit // 2), longest
        self.young, self.old = {}, {}

    def forget(self) -> None:
        self.young, self.old = {}, {}

    def _new(self, word: str):
        found = self.old.get(word)
        if found is None:
            found = self.compute(word)
        if len(word) <= self.longest:
            if len(self.young) >= self.half:
                self.young, self.old = {}, self.young
            self.young[word] = found
        return found

    def __call__(self, words: list[str]) -> list:
        found = list(map(self.young.get, words))
        if None in found:
            for k, value in enumerate(found):
                if value is None:
                    value = self.young.get(words[k])
                    found[k] = self._new(words[k]) if value is None else value
        return found


class Decoder:
    """The bytes that ids stand for."""

    def __init__(self, path: str = PIECES):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            else:
                control = sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
                self.bytes_of.append(b"" if control else piece.replace(SPACE, " ").encode())

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 bytes of ids; those of chunks follow each other, also where a character is split over them."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decoded(self, ids: pd.Series) -> list[bytes]:
        """``decode`` for little-endian unsigned 32-bit ids."""
        return [self.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]


def _kind(c: str) -> str:
    kind = unicodedata.category(c)[0]
    return kind if kind in "LN" else "L" if kind == "M" else "O"


class Vocabulary(Decoder):
    """Pieces (with blanks) and scores of a model file, and the best paths through words."""

    def __init__(self, path: str = PIECES, cached: int = Settings().cached):
        super().__init__(path)
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                piece = piece.replace(SPACE, " ")
                self.score[piece], self.id[piece] = sp.get_score(i), i
        self.unknown_id = sp.unk_id()
        self.width = max(map(len, self.score), default=1)
        self.unknown = min(self.score.values(), default=0.0) - UNKNOWN_PENALTY
        # A node of the tree of pieces: its children by character, and under "" the score of what ends here.
        self.tree: dict = {}
        for piece, score in self.score.items():
            node = self.tree
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = score
        self.word = self._word_pattern()
        self.ids_of = Remembered(lambda w: self.best_path(w)[1], cached)
        self.score_of = Remembered(lambda w: self.forward(w, 0, len(w))[0][-1], cached)

    def _word_pattern(self) -> re.Pattern:
        """What is segmented on its own. Every path has a border where no piece can reach over: in front of a
        blank behind another character, unless some piece has one inside, between two kinds of characters that
        no piece has side by side, and on both sides of a character that is in no longer piece."""
        bare = [p.lstrip(" ") for p in self.score if len(p) > 1]
        if any(" " in p for p in bare) or not any(bare):
            return re.compile("(?s).+")
        kinds = {k: {k} for k in "LNO"}
        for a, b in {(_kind(a), _kind(b)) for p in bare for a, b in zip(p, p[1:])}:
            merged = kinds[a] | kinds[b]
            for k in merged:
                kinds[k] = merged
        inner: dict[str, set[str]] = {}
        for c in {c for p in bare for c in p}:
            inner.setdefault("".join(sorted(kinds[_kind(c)])), set()).add(c)
        runs = [" *[" + "".join(sorted(map(re.escape, cs))) + "]+" for _, cs in sorted(inner.items())]
        return re.compile("(?s)" + "|".join([*runs, " +", "."]))

    # -------------------------------------------------- one stretch of text

    def forward(self, text: str, start: int, border: int) -> tuple[list[float], list[int]]:
        """Best score from ``start`` to every position, and where the last piece begins. No piece begins at
        or after ``border``."""
        n, tree, unknown = len(text), self.tree, self.unknown
        best, came = [LOWEST] * (n + 1), [-1] * (n + 1)
        best[start] = 0.0
        for i in range(start, min(border, n)):
            here = best[i]
            if here == LOWEST:
                continue
            node = tree.get(text[i])
            s = here + (unknown if node is None else node.get("", unknown))
            j = i + 1
            if s > best[j]:
                best[j], came[j] = s, i
            while node and j < n:
                node = node.get(text[j])
                if node is None:
                    break
                j += 1
                s = node.get("")
                if s is not None and here + s > best[j]:
                    best[j], came[j] = here + s, i
        return best, came

    def ids(self, text: str, came: list[int], start: int, end: int) -> list[int]:
        out = []
        while end > start:
            begin = came[end]
            piece = text[begin:end]
            if piece in self.id:
                out.append([self.id[piece]])
            elif self.byte_id:
                out.append([self.byte_id[b] for b in piece.encode("utf-8", "replace")])
            else:
                out.append([self.unknown_id])
            end = begin
        return [i for part in reversed(out) for i in part]

    def best_path(self, word: str) -> tuple[float, bytes]:
        """Score and ids of the best path through a whole word."""
        best, came = self.forward(word, 0, len(word))
        return best[-1], array("I", self.ids(word, came, 0, len(word))).tobytes()

    # -------------------------------------------------- one chunk

    def _cuts(self, text: str, n: int) -> tuple[int, int] | None:
        """The first and last position in (0, n] where every path has a border, or None."""
        ends = [m.end() for m in self.word.finditer(text) if m.end() < len(text)]
        inside = [e for e in ends if e <= n]
        return (inside[0], inside[-1]) if inside else None

    def transfer(self, text: str, n: int) -> np.ndarray:
        """The max-plus matrix of a chunk of ``n`` characters, ``text`` being the chunk and up to
        ``width - 1`` characters that follow: the best score from start + i to end + j."""
        width = self.width
        out = np.full((width, width), LOWEST)
        cuts = self._cuts(text, n)
        if cuts is None:
            for i in range(min(width, n + 1)):
                best, _ = self.forward(text, i, n)
                reach = best[n:n + width]
                out[i, :len(reach)] = reach
            for i in range(n, min(width, len(text) + 1)):
                out[i, i - n] = 0.0  # a piece that reaches over the whole chunk
            return out
        first, last = cuts
        head = [LOWEST] * width
        for i in range(min(width, first + 1)):
            head[i] = self.forward(text[:first], i, first)[0][first]
        middle = sum(self.score_of(self.word.findall(text[first:last])))
        reach = self.forward(text[last:], 0, n - last)[0][n - last:n - last + width]
        out[:, :len(reach)] = np.add.outer(np.array(head), middle + np.array(reach))
        return out

    def segment(self, text: str, n: int, i: int, j: int) -> bytes:
        """Ids (native unsigned integers) of the best path from start + i to end + j."""
        end = n + j
        cuts = self._cuts(text[:end + 1], n)
        if i >= end:
            return b""
        if cuts is None or cuts[0] < i:
            _, came = self.forward(text[:end], i, n)
            return array("I", self.ids(text, came, i, end)).tobytes()
        first, last = cuts
        _, came = self.forward(text[:first], i, first)
        out = [array("I", self.ids(text, came, i, first)).tobytes()]
        out += self.ids_of(self.word.findall(text[first:last]))
        tail = text[last:end]
        _, came = self.forward(tail, 0, n - last)
        out.append(array("I", self.ids(tail, came, 0, len(tail))).tobytes())
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        return b"".join(self.ids_of(self.word.findall(normalised(text))))


@lru_cache(maxsize=1)
def worker_vocabulary(path: str, cached: int) -> Vocabulary:
    return Vocabulary(path, cached)


def segmenting(path: str, cached: int) -> Vocabulary:
    """The worker's vocabulary, for tasks that need ids: the scores remembered for the matrices make room."""
    vocabulary = worker_vocabulary(path, cached)
    vocabulary.score_of.forget()
    return vocabulary


@lru_cache(maxsize=1)
def worker_decoder(path: str) -> Decoder:
    return Decoder(path)


def normalised(text: str) -> str:
    """With a blank in front (an empty text stays empty); U+2581 is a blank."""
    return " " + text.replace(SPACE, " ") if text else ""


# ---------------------------------------------------------------- max-plus algebra


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product; a stack of them in ``b`` is not needed, widths are small."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def product(matrices: list[np.ndarray]) -> np.ndarray:
    """Of a non-empty list, pairwise as a tree."""
    while len(matrices) > 1:
        matrices = [times(*matrices[k:k + 2]) if k + 1 < len(matrices) else matrices[k] for k in range(0, len(matrices), 2)]
    return matrices[0]


def states(matrices: list[np.ndarray], first: int, last: int) -> list[int]:
    """The state at every border of the best path from state ``first`` to state ``last``."""
    reached = [np.where(np.arange(len(matrices[0])) == first, 0.0, LOWEST)]
    for m in matrices:
        reached.append((reached[-1][:, None] + m).max(axis=0))
    out = [last]
    for k in range(len(matrices) - 1, -1, -1):
        out.append(int(np.argmax(reached[k] + matrices[k][:, out[-1]])))
    return out[::-1]


# ---------------------------------------------------------------- documents


def sliced(batches: Iterator[pd.DataFrame], column: str, most: int) -> Iterator[pd.DataFrame]:
    """The rows of the batches in slices of at most ``most`` characters in ``column`` (one row at least): ids and bytes of
    a batch of 10,000 long texts are several times its size."""
    for batch in batches:
        before = batch[column].str.len().cumsum().to_numpy()
        first = 0
        while first < len(batch):
            done = before[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(before, done + most, side="right")))
            yield batch.iloc[first:last].reset_index(drop=True)
            first = last


def encode_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = PIECES,
                     settings: Settings = Settings(), decoded: bool = False) -> DataFrame:
    """A row per chunk: ``doc_id``, ``chunk`` (from 0), ``n_chunks``, ``n_chars`` (of the normalised text),
    ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit); the ids of a document are those of its chunks.
    With ``decoded`` also ``utf8`` as ``decode_chunks`` adds it, in the same worker.

    The normalised text has a blank in front. Characters without a piece become bytes (or the unknown id, in a
    vocabulary without bytes). A null or empty text is one empty chunk. Repeated rows are encoded each; null ids
    are kept; other columns are not read. An empty table gives no rows. Chunks are known by 128 bits of hash of
    their whole text, so the order of the input does not matter, and the matrices of copies are combined once.
    """
    value = F.coalesce(docs[text], F.lit(""))
    source = docs.select(docs[doc_id].alias("doc_id"), value.alias("_text"))
    size, cached, block = settings.chunk, settings.cached, settings.block
    id_field = source.schema["doc_id"]
    counts = [T.StructField(c, T.LongType()) for c in ("chunk", "n_chunks", "n_chars")]
    key = [T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]
    cut_schema = T.StructType([*key, id_field, *counts, T.StructField("piece", T.StringType())])
    out_schema = T.StructType([id_field, *counts, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                               *([T.StructField("utf8", T.BinaryType())] if decoded else [])])
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = worker_vocabulary(path, cached).width

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b, doc, value in zip(batch["a"], batch["b"], batch["doc_id"], batch["_text"], strict=True):
                value = normalised(value)
                starts = range(0, len(value), size)
                yield pd.DataFrame({
                    "a": a, "b": b, "doc_id": pd.array([doc] * len(starts), dtype=batch["doc_id"].dtype), "chunk": range(len(starts)),
                    "n_chunks": len(starts), "n_chars": [min(size, len(value) - at) for at in starts],
                    "piece": [value[at:at + size + width - 1] for at in starts]})

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Texts of one chunk, from their start to their end."""
        vocabulary = segmenting(path, cached)
        for batch in sliced(batches, "_text", settings.slice_chars):
            texts = batch["_text"].tolist()
            yield _result(pd.DataFrame({"doc_id": batch["doc_id"], "chunk": 0, "n_chunks": 1, "n_chars": [len(t) + 1 if t else 0 for t in texts]}),
                          [vocabulary.encode(t) for t in texts])

    def matrix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = worker_vocabulary(path, cached)
        for batch in sliced(batches, "piece", settings.slice_chars):
            yield batch[["a", "b", "chunk"]].assign(block=batch["chunk"] // block, m=[
                vocabulary.transfer(t, n).tobytes() for t, n in zip(batch["piece"], batch["n_chars"], strict=True)])

    def square(m: bytes) -> np.ndarray:
        return np.frombuffer(m).reshape(width, width)

    def over_runs(batches: Iterator[pd.DataFrame], n_keys: int, solve: Callable, names: list[str]) -> Iterator[pd.DataFrame]:
        """``solve`` for every run of rows that are equal in their first columns; a run may go over batches."""
        rows = (row for batch in batches for row in batch.itertuples(index=False, name=None))
        found = (out for _, run in groupby(rows, lambda row: row[:n_keys]) for out in solve(list(run)))
        while part := list(islice(found, 5000)):
            yield pd.DataFrame(part, columns=names)

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return over_runs(batches, 3, lambda run: [(*run[0][:3], product([square(r[4]) for r in run]).tobytes())], ["a", "b", "block", "m"])

    def of_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solve(run: list[tuple]) -> list[tuple]:
            at = states([square(r[3]) for r in run], 0, 0)
            return [(*r[:3], i, j) for r, i, j in zip(run, at, at[1:])]
        return over_runs(batches, 2, solve, ["of_a", "of_b", "of_block", "i", "j"])

    def of_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solve(run: list[tuple]) -> list[tuple]:
            at = states([square(r[4]) for r in run], run[0][5], run[0][6])
            return [(*r[:2], r[3], i, j) for r, i, j in zip(run, at, at[1:])]
        return over_runs(batches, 3, solve, ["of_a", "of_b", "of_chunk", "i", "j"])

    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = segmenting(path, cached)
        for batch in sliced(batches, "piece", settings.slice_chars):
            yield _result(batch, [vocabulary.segment(t, n, i, j) for t, n, i, j in zip(
                batch["piece"], batch["n_chars"], batch["i"], batch["j"], strict=True)])

    def _result(batch: pd.DataFrame, ids: list[bytes]) -> pd.DataFrame:
        out = pd.DataFrame({**{c: batch[c] for c in ("doc_id", "chunk", "n_chunks", "n_chars")},
                            "n_tokens": [len(x) // 4 for x in ids],
                            "ids": [np.frombuffer(x, np.uint32).astype("<u4").tobytes() for x in ids]})
        return out.assign(utf8=worker_vocabulary(path, cached).decoded(out["ids"])) if decoded else out

    long = source.where(F.length("_text") >= size).select(F.xxhash64("_text").alias("a"), F.xxhash64(F.lit("text"), "_text").alias("b"), "doc_id", "_text")
    several = long.mapInPandas(cut, cut_schema)
    # Read twice, going up and coming down: computed once, into the shared folder (2 KB a chunk of a distinct text).
    ks = "a long, b long, "
    each = several.mapInPandas(matrix, ks + "chunk long, block long, m binary").groupBy("a", "b", "block", "chunk").agg(F.first("m").alias("m"))
    matrices = written(each)
    in_order = matrices.repartition(n_parts, "a", "b", "block").sortWithinPartitions("a", "b", "block", "chunk")
    per_block = in_order.mapInPandas(combine, ks + "block long, m binary").repartition(n_parts, "a", "b").sortWithinPartitions("a", "b", "block")
    borders = per_block.mapInPandas(of_blocks, "of_a long, of_b long, of_block long, i long, j long")
    on = (matrices["a"] == borders["of_a"]) & (matrices["b"] == borders["of_b"]) & (matrices["block"] == borders["of_block"])
    met = matrices.join(borders.hint("shuffle_hash"), on).select("a", "b", "block", "chunk", "m", "i", "j")
    known = met.repartition(n_parts, "a", "b", "block").sortWithinPartitions("a", "b", "block", "chunk").mapInPandas(
        of_chunks, "of_a long, of_b long, of_chunk long, i long, j long")
    # The states are slim, so they are the side that is hashed; the chunks need no sort.
    placed = several.join(known.hint("shuffle_hash"), (several["a"] == known["of_a"]) & (several["b"] == known["of_b"])
                          & (several["chunk"] == known["of_chunk"])).drop("of_a", "of_b", "of_chunk")
    return source.where(F.length("_text") < size).mapInPandas(whole, out_schema).unionByName(placed.mapInPandas(trace, out_schema))


def decode_chunks(encoded: DataFrame, path: str = PIECES, settings: Settings = Settings()) -> DataFrame:
    """Add ``utf8``, the bytes that the ids of each chunk stand for. Those of a document, in the order of its
    chunks, are its text with a blank in front (U+2581 in a text reads as a blank, as in the library)."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("utf8", T.BinaryType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = worker_decoder(path)
        for batch in batches:
            yield batch.assign(utf8=decoder.decoded(batch["ids"]))

    return encoded.mapInPandas(run, schema)
