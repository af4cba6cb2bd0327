"""DataFrame operators: profiling, reconciliation, quality, conforming, DDL, set operations."""
