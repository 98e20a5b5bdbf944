"""sheetrecon: reconcile loosely structured delimited sheets against a
relational schema with plain Spark DataFrame plans.

Layout
------
sources/    sheet scans with row positions, table catalogs, sinks
functions/  Column-level helpers (strip, key predicates, formats, text)
operators/  DataFrame -> DataFrame building blocks (keys, lookup, pick,
            fill, profile, explore, run log)
plans/      end-to-end plans (fill pipeline) and the test-table stand-ins
streaming/  Structured Streaming variants (incremental fill, run-log totals)
"""

__version__ = "0.1.0"
