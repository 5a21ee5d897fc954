"""Fill-in-middle transformation: a text is cut into prefix, middle and suffix, which are written in another order.

Cuts lie between units (runs of letters, or single other characters). One full match of ``(unit)*`` by the
regex library keeps every repetition of its group, so the ends of the group give the number of units and both
cut offsets at once; no unit is looked at in Python. Which texts are cut, where, and in which order follows
from a hash of the document's id, so a lost task makes the same output again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Settings(NamedTuple):
    unit: str = "[A-Za-z]+|[^A-Za-z]"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: str = "1:"           # in front of the id that is hashed
    cut_percent: int = 90      # of texts that are cut at all
    spm_percent: int = 20      # of those, with the suffix first


COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")


def _drawn(doc_id: Column, settings: Settings) -> list[Column]:
    """Four unsigned 32-bit numbers from the id (null: the seed alone)."""
    digest = F.sha2(F.concat(F.lit(settings.seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """A row per input row: ``doc_id``, ``n`` (units of the whole text), ``form``, ``prefix_chars``,
    ``middle_chars`` (code points; null if plain) and ``output``.

    Form ``psm`` is prefix, suffix, middle, each behind its marker; ``spm`` has the suffix first; ``plain`` is
    the text itself: empty and null texts, texts that hold a marker, and those not drawn. Ids and texts may
    repeat: each row is transformed, equal ids draw alike. A null id draws as the seed alone. Other columns
    are not read. An empty table gives no rows. A task holds one batch of texts, and one number per unit of
    the text at hand.
    """
    h1, h2, h3, h4 = _drawn(docs[doc_id], settings)
    source = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("_text"), h1.alias("_h1"),
                         h2.alias("_h2"), (h3 % 100 < settings.cut_percent).alias("_cut"), (h4 % 100 < settings.spm_percent).alias("_spm"))
    long = T.LongType()
    schema = T.StructType([source.schema["doc_id"], T.StructField("n", long), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", long), T.StructField("middle_chars", long), T.StructField("output", T.StringType())])
    p, s, m = settings.prefix, settings.suffix, settings.middle

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units = regex.compile(f"({settings.unit})*")
        for batch in batches:
            rows = []
            for value, h1, h2, cut, spm in zip(*(batch[c] for c in ("_text", "_h1", "_h2", "_cut", "_spm")), strict=True):
                ends = units.fullmatch(value).ends(1)
                n = len(ends)
                if not cut or not value or p in value or s in value or m in value:
                    rows.append((n, "plain", None, None, value))
                    continue
                low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                a, b = (ends[k - 1] if k else 0 for k in (low, high))
                head, inner, tail = value[:a], value[a:b], value[b:]
                output = s + tail + p + head + m + inner if spm else p + head + s + tail + m + inner
                rows.append((n, "spm" if spm else "psm", a, b - a, output))
            out = pd.DataFrame(rows, columns=list(COLUMNS[1:]), index=batch.index)
            out[["prefix_chars", "middle_chars"]] = out[["prefix_chars", "middle_chars"]].astype("Int64")
            out.insert(0, "doc_id", batch["doc_id"])
            yield out

    return source.mapInPandas(run, schema)


def restored(output: Column, form: Column, settings: Settings = Settings()) -> Column:
    """The exact text, from an output and its form alone.

    A cut text holds no marker, and no marker can form across a border, as each begins with a character that
    it has only there; so the markers split the output into its three parts.
    """
    markers = "|".join(rf"\Q{x}\E" for x in (settings.prefix, settings.suffix, settings.middle))
    part = F.split(output, markers, -1)
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
