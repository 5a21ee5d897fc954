"""Nucleotide-sequence expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def revcomp(col) -> Column:
    """Reverse complement over ACGT (other letters are kept, e.g. N)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.reverse(F.translate(c, "ACGT", "TGCA"))


def kmer_code(col, k: int = 15) -> Column:
    """A k-mer over ACGT as an exact BIGINT key.

    For k <= 18 the digits 0-3 read as a decimal number (injective because all
    k-mers have the same length, and a plain string→long cast); up to k = 31
    the base-4 value via ``conv``.  Joining on a long instead of a string keeps
    the k-mer join in fixed-width codegen'd rows.  Callers drop k-mers with
    other letters first.
    """
    c = F.col(col) if isinstance(col, str) else col
    digits = F.translate(c, "ACGT", "0123")
    if k <= 18:
        return digits.cast("bigint")
    return F.conv(digits, 4, 10).cast("bigint")


def acgt_only(col) -> Column:
    """True when the sequence has only A, C, G, T."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike("^[ACGT]*$")
