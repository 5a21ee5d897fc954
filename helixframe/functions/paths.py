"""Object-path expressions.

Object stores have a flat namespace: a "directory" is a name prefix ending in
``/``.  These helpers parse names the way the run-reconciliation rules need.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_int(col) -> Column:
    """Integer text as a 32-bit decoder accepts it: optional sign, ASCII digits,
    in range.  Anything else (empty, blanks, letters, overflow) is null."""
    c = _c(col)
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("int"))


def dir_of(col) -> Column:
    """Everything up to and including the last ``/`` ('' when there is none)."""
    return F.regexp_extract(_c(col), r"^(.*/)", 1)


def file_name(col) -> Column:
    """Text after the last ``/``."""
    return F.substring_index(_c(col), "/", -1)


def mate_suffix(name_col) -> Column:
    """Mate number of a file name: the token after the last ``_`` (trailing
    ``_`` ignored), cut at the first ``.``, as an int; null when it does not parse."""
    name = _c(name_col)
    last = F.substring_index(F.regexp_replace(name, r"_+$", ""), "_", -1)
    return java_int(F.substring_index(last, ".", 1))


def ancestor_dirs(path_col) -> Column:
    """All directory prefixes of a path, from the root ('') down to its own dir."""
    parts = F.split(_c(path_col), "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda i: F.when(i == 0, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))),
    )


def depth_of(path_col) -> Column:
    """How many ``/`` a path has: for a directory, its place among the ``ancestor_dirs`` of its files."""
    return F.size(F.split(_c(path_col), "/")) - 1


def ancestor_at(path_col, depth: Column) -> Column:
    """The ancestor directory of that depth, of a path that is at least as deep."""
    return F.when(depth == 0, F.lit("")).otherwise(F.concat(F.call_function("substring_index", _c(path_col), F.lit("/"), depth), F.lit("/")))


def strip_scheme(col) -> Column:
    """``file:/a/b`` / ``gs://bucket/a/b`` → the path part."""
    return F.regexp_replace(_c(col), _SCHEME, "")


def relative_to(col, root: str) -> Column:
    """Path of an object relative to a listing root (scheme and authority ignored)."""
    root_path = re.sub(_SCHEME, "", root).rstrip("/")
    bare = strip_scheme(col)
    if not root_path:
        return F.regexp_replace(bare, r"^/+", "")
    return F.regexp_replace(bare, "^/*" + re.escape(root_path.lstrip("/")) + "/", "")
