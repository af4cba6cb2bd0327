"""tableferry — move relational tables between systems on Spark and prove they arrived intact.

Every step is a DataFrame -> DataFrame operator:

* ``sources``   — table scans (parquet / JDBC), the column catalog, paging.
* ``functions`` — column expressions: type mapping, name conversion, value conforming.
* ``operators`` — profiling, reconciliation, quality checks, DDL rendering, set operations.
* ``plans``     — loads (sinks) and whole-database jobs whose results are DataFrames.
* ``streaming`` — incremental file-to-table transfer with Structured Streaming.
"""

from tableferry.session import build_session, shared_dir, new_run_dir

__all__ = ["build_session", "shared_dir", "new_run_dir"]
