"""helixframe: a Spark-native sequencing-run pipeline.

Run manifests, object listings, reads, references, alignments and variants are
all DataFrames; every operator takes and returns DataFrames and stays lazy.
"""

from helixframe.session import build_session, staging_dir

__all__ = ["build_session", "staging_dir"]
