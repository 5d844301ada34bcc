"""vexa: vector and hybrid-search analytics expressed as ordinary Spark jobs.

Every public function takes and returns DataFrames; nothing keeps a global
session.  Sub-packages:

* ``sources``   – Parquet / JSON / text readers and writers, schema checks,
                  partitions, synthetic rows.
* ``functions`` – Column builders: vector metrics, bit packing, predicates,
                  tokenizer.
* ``operators`` – exact and approximate top-k search, DML, maintenance,
                  text retrieval, fusion, evaluation.
* ``plans``     – the registered end-to-end queries over the test tables and
                  their SQL oracles.
* ``streaming`` – Structured Streaming jobs (append, upsert, delete log, TTL,
                  incremental cell assignment).
"""

from vexa.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
