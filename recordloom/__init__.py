"""recordloom: a PySpark-native engine for versioned record data.

Subpackages: ``operators`` (selection, links, diffs, quality), ``functions``
(text, numbers, dates, keys), ``sources`` (scans and sinks), ``plans`` (the
registered queries and their SQL), ``streaming`` (incremental ingest).
"""
