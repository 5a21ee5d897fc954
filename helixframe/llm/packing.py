"""Lexical retrieval packing.

Documents are tokenised and routed by content: a tree of two-way splits, fitted on random projections of the
BM25 vectors of a bounded sample, gives every document a path, and a range partition by path puts documents of
like words next to each other. It is cut into shards of bounded size. A shard holds a BM25 inverted index of its
documents over token ids, with the document frequencies of the whole corpus. Windows are filled one after the
other: the document that opens a window is the seed, the index scores all terms of the seed and returns its
nearest documents not used yet, and these fill the window greedily; the last one is cut at the border, and what
is left of it opens the next window. Without neighbours the next unused document follows. So only the end of a
shard can be short of a window, and it is cut into sequences of powers of two: nothing is padded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.llm import tokenizer as tk
from helixframe.llm.common import input_bytes
from helixframe.session import staging_dir


class Settings(NamedTuple):
    window: int = 2048
    end_id: int = 1                 # follows every document
    shard_bytes: int = 8 << 20      # text in a shard, about
    sample: int = 4096              # documents that the routes are fitted on, about (at most twice as many)
    projected: int = 64             # dimensions of their projections
    least_split: int = 32           # sampled documents that are split further
    k1: float = 1.2
    b: float = 0.75


# ---------------------------------------------------------------- tokens


def tokenise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", end_id: int = 1, path: str = tk.BYTE_BPE) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned integers, 16-bit if the vocabulary allows) and ``n``.

    Ids are the tokenizer's without added tokens, then ``end_id``; a null text is an empty one.
    """
    source = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("_text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("ids", T.BinaryType()), T.StructField("n", T.LongType())])
    kind = id_type(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = tk.worker_encoder(path, "H" if kind == "<u2" else "I")
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            ids = [encoder.encode(t) + end for t in batch["_text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids, "n": [len(x) // np.dtype(kind).itemsize for x in ids]})

    return source.mapInPandas(run, schema)


def id_type(path: str) -> str:
    return "<u2" if tk.load(path).get_vocab_size() <= 1 << 16 else "<u4"


# ---------------------------------------------------------------- the corpus and its routes


class Corpus(NamedTuple):
    """Documents, their mean length, and per token id the number of documents that hold it."""

    n: int
    mean: float
    df: np.ndarray

    def weights(self, terms: np.ndarray, tf: np.ndarray, length: np.ndarray | int, settings: Settings) -> np.ndarray:
        df = self.df[terms]
        return np.log1p((self.n - df + 0.5) / (df + 0.5)) * tf * (settings.k1 + 1) / (
            tf + settings.k1 * (1 - settings.b + settings.b * length / max(1.0, self.mean)))


def corpus_of(tokens: DataFrame, path: str = tk.BYTE_BPE, end_id: int = 1) -> Corpus:
    """Counted over all documents; a row per token id comes to the driver, so at most the vocabulary."""
    size, kind = max(tk.load(path).get_vocab_size(), end_id + 1), id_type(path)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tk.give_back()  # all ids are made and written
        df, docs, ids = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for held in batch["ids"]:
                terms = np.frombuffer(held, kind)
                df[np.unique(terms)] += 1
                docs, ids = docs + 1, ids + len(terms)
        found = np.flatnonzero(df)
        yield pd.DataFrame({"term": [*found, -1, -2], "n": [*df[found], docs, ids]})

    rows = tokens.select("ids").mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    sums = {r["term"]: r["n"] for r in rows}
    docs, ids = sums.pop(-1, 0), sums.pop(-2, 0)
    df = np.zeros(size, np.int64)
    df[list(sums)] = list(sums.values())
    return Corpus(docs, ids / max(1, docs), df)


@lru_cache(maxsize=2)
def _projection(terms: int, dims: int) -> np.ndarray:
    return np.random.default_rng(0).standard_normal((terms, dims), np.float32)


def project(docs: list[np.ndarray], corpus: Corpus, settings: Settings) -> np.ndarray:
    """Random projections of the documents' BM25 vectors, of length one."""
    table = _projection(len(corpus.df), settings.projected)
    out = np.zeros((len(docs), settings.projected), np.float32)
    for row, doc in zip(out, docs, strict=True):
        terms, tf = np.unique(doc, return_counts=True)
        row[:] = corpus.weights(terms, tf, len(doc), settings).astype(np.float32) @ table[terms]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


class Routes(NamedTuple):
    """Two centres per node of a tree, and the nodes behind them (0: none). A path is read from the root, node 0."""

    centres: np.ndarray
    following: np.ndarray

    DEPTH = 30

    def paths(self, projected: np.ndarray) -> np.ndarray:
        """The turns taken, first ones in the highest bits, so that like paths are near each other."""
        path, node = np.zeros(len(projected), np.int64), np.zeros(len(projected), np.int64)
        going = np.full(len(projected), len(self.centres) > 0)
        for depth in range(self.DEPTH):
            rows = np.flatnonzero(going)
            if not len(rows):
                break
            turn = np.einsum("rcd,rd->rc", self.centres[node[rows]], projected[rows]).argmax(axis=1)
            path[rows] |= turn << (self.DEPTH - 1 - depth)
            node[rows] = self.following[node[rows], turn]
            going[rows] = node[rows] > 0
        return path


def fit_routes(sample: np.ndarray, settings: Settings) -> Routes:
    """Split the sample in two by nearest centre, again and again; points that lie together stay together."""
    centres, following = [], []

    def split(rows: np.ndarray, depth: int) -> int:
        if len(rows) < settings.least_split or depth == Routes.DEPTH:
            return 0
        x = sample[rows]
        first = x[0]
        pair = np.stack([first, x[(x @ first).argmin()]])
        for _ in range(10):
            side = (x @ pair.T).argmax(axis=1)
            if not 0 < side.sum() < len(side):
                return 0
            pair = np.stack([x[side == i].mean(axis=0) for i in (0, 1)])
        side = (x @ pair.T).argmax(axis=1)
        node = len(centres)
        centres.append(pair)
        following.append([0, 0])
        for i in (0, 1):
            following[node][i] = split(rows[side == i], depth + 1)
        return node

    split(np.arange(len(sample)), 0)
    return Routes(np.array(centres, np.float32).reshape(-1, 2, settings.projected), np.array(following, np.int64).reshape(-1, 2))


def routed(tokens: DataFrame, corpus: Corpus, settings: Settings = Settings(), path: str = tk.BYTE_BPE) -> DataFrame:
    """``tokens`` with the ``route`` of every document."""
    kind = id_type(path)
    dims = [f"p{i}" for i in range(settings.projected)]

    def projections(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(project([np.frombuffer(x, kind) for x in batch["ids"]], corpus, settings), columns=dims)

    rate = max(1, corpus.n // settings.sample)
    picked = tokens.where(F.pmod(F.xxhash64("ids", "doc_id"), F.lit(rate)) == 0).select("ids").limit(2 * settings.sample)
    sample = picked.mapInPandas(projections, ", ".join(f"{d} float" for d in dims)).toPandas().to_numpy(np.float32)
    routes = fit_routes(sample[np.lexsort(sample.T)], settings)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = project([np.frombuffer(x, kind) for x in batch["ids"]], corpus, settings)
            yield batch.assign(route=routes.paths(held))

    return tokens.mapInPandas(walk, T.StructType([*tokens.schema.fields, T.StructField("route", T.LongType())]))


# ---------------------------------------------------------------- the index of a shard


class Index:
    """BM25 postings over the token ids of a shard's documents."""

    def __init__(self, docs: list[np.ndarray], settings: Settings, corpus: Corpus | None = None):
        n = len(docs)
        lengths = np.array([len(d) for d in docs], np.int64)
        terms = np.concatenate(docs).astype(np.int64) if n else np.empty(0, np.int64)
        owner = np.repeat(np.arange(n), lengths)
        pair, tf = np.unique(owner << 32 | terms, return_counts=True)
        doc, term = pair >> 32, pair & 0xFFFFFFFF
        here = np.bincount(term)
        corpus = corpus or Corpus(n, float(lengths.mean()) if n else 0.0, here)
        weight = corpus.weights(term, tf, lengths[doc], settings)
        # Per document its terms; a term that no other document of the shard holds finds nothing.
        shared = here[term] > 1
        self.doc_bounds = np.searchsorted(doc[shared], np.arange(n + 1))
        self.doc_terms, self.doc_weights = term[shared], weight[shared]
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = doc[order], weight[order]
        self.bounds = np.concatenate([[0], np.cumsum(here)])
        self.settings, self.n = settings, n

    def forget(self, used: np.ndarray) -> None:
        """Drop the postings of used documents; the others keep their order, so scores stay the same to the bit."""
        keep = ~used[self.docs]
        self.bounds = np.concatenate([[0], np.cumsum(keep)])[self.bounds]
        self.docs, self.weights = self.docs[keep], self.weights[keep]

    def neighbours(self, seed: int, used: np.ndarray, wanted: int) -> np.ndarray:
        """Unused documents by falling BM25 score for all terms of the seed, ties in shard order."""
        terms = self.doc_terms[self.doc_bounds[seed]:self.doc_bounds[seed + 1]]
        spans = [slice(a, b) for a, b in zip(self.bounds[terms].tolist(), self.bounds[terms + 1].tolist(), strict=True)]
        if not spans:
            return np.empty(0, np.int64)
        score = np.bincount(np.concatenate([self.docs[s] for s in spans]), np.concatenate([self.weights[s] for s in spans]), self.n)
        score[used] = 0
        found = np.flatnonzero(score)
        if len(found) > wanted:
            found = found[np.argpartition(-score[found], wanted)[:wanted]]
        return found[np.lexsort((found, -score[found]))]


def powers_of_two(n: int) -> list[int]:
    """``n`` as falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_shard(lengths: list[int], index: Index, settings: Settings) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that lay out all documents of a shard.

    The index forgets documents that were placed, whenever a tenth of those left is new among them."""
    window, n = settings.window, len(lengths)
    used, pieces = np.zeros(n, bool), []
    sequence = filled = next_free = 0
    seed, near = None, None  # near: neighbours still to try; null once the index has no more
    placed = forgotten = 0

    def following() -> int | None:
        nonlocal near, next_free
        while seed is not None and near is not None:
            while near:
                if not used[found := near.pop()]:
                    return found
            near = index.neighbours(seed, used, 64)[::-1].tolist() or None
        while next_free < n and used[next_free]:
            next_free += 1
        return next_free if next_free < n else None

    while (doc := following()) is not None:
        used[doc] = True
        placed += 1
        if 10 * (placed - forgotten) > n - forgotten:
            index.forget(used)
            forgotten = placed
        start, left = 0, lengths[doc]
        while left:
            if filled == 0:
                seed, near = doc, []
            take = min(left, window - filled)
            pieces.append((doc, start, take, sequence, filled))
            start, left, filled = start + take, left - take, filled + take
            if filled == window:
                sequence, filled = sequence + 1, 0
                seed, near = doc, []
    return pieces if filled == 0 else _cut_end(pieces, sequence, filled)


def _cut_end(pieces: list[tuple], last: int, filled: int) -> list[tuple]:
    """The unfilled last sequence as sequences of powers of two."""
    out = [p for p in pieces if p[3] != last]
    borders, at = [], 0
    for size in powers_of_two(filled):
        borders.append((at, at + size))
        at += size
    for doc, start, length, _, offset in (p for p in pieces if p[3] == last):
        for i, (a, b) in enumerate(borders):
            low, high = max(a, offset), min(b, offset + length)
            if low < high:
                out.append((doc, start + low - offset, high - low, last + i, low - a))
    return out


# ---------------------------------------------------------------- packing


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written, compressed, to the cluster's shared folder, and read back."""
    at = staging_dir(df.sparkSession, f"packing-{purpose}")
    df.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings(),
         path: str = tk.BYTE_BPE) -> DataFrame:
    """Pack all documents; a row per piece.

    Columns: ``doc_id``, ``start`` (the document's ids before the piece), ``length``, ``ids`` (little-endian
    unsigned 32-bit), ``doc_tokens`` (the document's ids with the end id), ``sequence_id``, ``offset``
    (gapless from 0 in every sequence) and ``shard``. Sequences hold ``window`` ids or a smaller power of two.

    Neighbours are exact inside a shard; a neighbour that the routes sent to another shard is missed. A shard
    ends with the document that reaches ``shard_bytes`` (at four bytes an id), however its route is shared.

    Every id is in exactly one piece. A null text is an empty one: the end id alone. Repeated rows, also of
    the same id, are packed each. Null ids are kept. Very long documents run through many windows. Columns
    beyond the two are not read. An empty table gives an empty result.
    """
    tokens = _stored(tokenise(docs, doc_id, text, settings.end_id, path), "tokens")
    corpus = corpus_of(tokens, path, settings.end_id)
    found = _stored(routed(tokens, corpus, settings, path), "routed")
    n_parts = max(1, math.ceil(input_bytes(docs, text) / settings.shard_bytes))
    # The range keys are sampled to the driver, so they hold no ids.
    keys = ["route", F.xxhash64("doc_id", "ids"), "doc_id"]
    kind = id_type(path)
    schema = T.StructType([tokens.schema["doc_id"], *T.StructType.fromDDL(
        "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, shard long").fields])

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, total = [], 0
        for batch in batches:
            done = 0
            for i, n in enumerate(batch["n"].tolist()):
                total += n
                if total >= settings.shard_bytes // 4:
                    yield pd.concat([*held, batch.iloc[done:i + 1]], ignore_index=True)
                    held, done, total = [], i + 1, 0
            held.append(batch.iloc[done:])
        if total:
            yield pd.concat(held, ignore_index=True)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Sequences are numbered within the range partition, whose rows are in a fixed order.
        first = TaskContext.get().partitionId() << 32
        for shard in shards(batches):
            ids = [np.frombuffer(x, kind) for x in shard["ids"]]
            pieces = pack_shard([len(x) for x in ids], Index(ids, settings, corpus), settings)
            names = shard["doc_id"].to_numpy()
            frame = pd.DataFrame(pieces, columns=["doc", "start", "length", "sequence", "offset"])
            yield pd.DataFrame({
                "doc_id": pd.array(names[frame["doc"]], dtype=shard["doc_id"].dtype), "start": frame["start"], "length": frame["length"],
                "ids": [ids[d][s:s + n].astype("<u4").tobytes() for d, s, n in zip(frame["doc"], frame["start"], frame["length"], strict=True)],
                "doc_tokens": [len(ids[d]) for d in frame["doc"]],
                "sequence_id": frame["sequence"] + first, "offset": frame["offset"], "shard": first})
            first += int(frame["sequence"].max()) + 1
            del shard, ids, pieces, names, frame
        tk.give_back()

    return found.repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys, "ids").select(
        "doc_id", "ids", "n").mapInPandas(solve, schema)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
