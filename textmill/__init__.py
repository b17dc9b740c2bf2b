"""textmill: Spark-native text-corpus preparation.

Every public function takes and returns DataFrames so steps chain with
``DataFrame.transform``. Subpackages:

* ``sources``   readers for CSV / vocabulary files / driver tables, and sinks
* ``functions`` Column-level helpers (keyed draws, array expressions, constants)
* ``operators`` relational building blocks (vocabulary, encoding, examples, ...)
* ``plans``     end-to-end jobs wired from operators, and the query registry
* ``streaming`` Structured Streaming variants of the batch jobs
"""

from textmill.session import build_session, checkpoint_dir, cut_lineage

__all__ = ["build_session", "checkpoint_dir", "cut_lineage"]
