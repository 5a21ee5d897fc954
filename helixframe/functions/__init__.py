"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from helixframe.functions.paths import (
    ancestor_dirs, dir_of, file_name, java_int, mate_suffix, relative_to, strip_scheme,
)
from helixframe.functions.seq import acgt_only, kmer_code, revcomp

__all__ = [
    "ancestor_dirs", "dir_of", "file_name", "java_int", "mate_suffix", "relative_to",
    "strip_scheme", "acgt_only", "kmer_code", "revcomp",
]
