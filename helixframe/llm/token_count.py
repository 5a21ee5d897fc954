"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is encoded alone; those that come back as the one id they stand for are
proven whole tokens. A text is cut into pre-tokens; proven ones count one without any merging, and only
the others are merged by the tokenizer. The count of a text needs no other row, so there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.llm import tokenizer as tk


def whole_tokens(path: str = tk.BYTE_BPE) -> frozenset[str]:
    """Vocabulary strings that, encoded alone, are one pre-token and one token: themselves.

    The proof is the encoding itself, once per vocabulary string. Special tokens are left out (they are
    found before pre-tokens are cut), as are strings that are no valid UTF-8.
    """
    tokenizer = tk.load(path)
    special = set(tokenizer.get_added_tokens_decoder())
    ids = [i for i in range(tokenizer.get_vocab_size()) if i not in special]
    texts = tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False)
    found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return frozenset(t for i, t, e in zip(ids, texts, found, strict=True)
                     if e.ids == [i] and "�" not in t and tk.pre_tokens(t, path) == [t])


class Counter:
    """Counts tokens of texts: proven whole tokens count one, other pre-tokens what they merge to."""

    def __init__(self, whole: frozenset[str], path: str = tk.BYTE_BPE, limit: int = tk.CACHED):
        self.whole, self.path = whole, path
        self.merge = tk.Merger(len, dict.fromkeys(whole, 1), path, limit)

    def count(self, text: str) -> tuple[int, int]:
        """Tokens, and how many of them were counted directly."""
        pieces = tk.pre_tokens(text, self.path)
        return sum(self.merge(pieces)), sum(map(self.whole.__contains__, pieces))


_OF_WORKER: dict[tuple, Counter] = {}


def worker_counter(whole: frozenset[str], path: str) -> Counter:
    """The counter that the tasks of one Python worker share, with what it remembers."""
    if (path, len(whole)) not in _OF_WORKER:
        _OF_WORKER.clear()
        _OF_WORKER[path, len(whole)] = Counter(whole, path)
    return _OF_WORKER[path, len(whole)]


def count_tokens(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limit: int = 512,
                 path: str = tk.BYTE_BPE) -> DataFrame:
    """Per row: the ``keep`` columns, ``n_bytes`` (UTF-8), ``n_tokens``, ``n_direct`` (tokens found by the
    shortcut) and ``over_limit`` (``n_tokens > limit``).

    Counts are those of the tokenizer file without added tokens, truncation or padding; special strings
    inside a text are special tokens, as is the library's default. Null text counts as empty: no bytes, no
    tokens. Repeated rows are counted alike and all kept; an empty table gives an empty result. ``keep``
    columns must not be named like an added one.
    """
    added = ("n_bytes", "n_tokens", "n_direct", "over_limit")
    clash = set(keep) & set(added)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are added by count_tokens")
    source = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = T.StructType([source.schema[c] for c in keep]
                          + [T.StructField(c, T.LongType()) for c in added[:3]] + [T.StructField(added[3], T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))  # bounded by the vocabulary

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = worker_counter(shared.value, path)
        for batch in batches:
            texts = batch.pop("_text").tolist()
            counted = [counter.count(t) for t in texts]
            batch["n_bytes"] = [len(t.encode()) for t in texts]
            batch["n_tokens"] = [n for n, _ in counted]
            batch["n_direct"] = [d for _, d in counted]
            batch["over_limit"] = [n > limit for n, _ in counted]
            yield batch[[f.name for f in schema]]

    return source.mapInPandas(run, schema)
