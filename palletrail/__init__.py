"""Warehouse-ledger analytics as plain Spark DataFrame jobs.

Layers, from the inside out:

``functions``  column expressions (attribute parsing, rule tables, time, text)
``operators``  DataFrame -> DataFrame building blocks (pairing, netting, lookups, ...)
``sources``    readers and idempotent sinks
``plans``      the user-level reports: tables and parameters in, one DataFrame out
``streaming``  the Structured Streaming versions of the board and of ledger ingest
"""

__version__ = "0.1.0"
