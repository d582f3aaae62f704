"""Ingestion and table maintenance on Spark DataFrames.

Layers, from the inside out:

* ``functions``  - column expressions and small projections
* ``operators``  - DataFrame -> DataFrame transforms (dedup, upsert, merge, checks, SQL joins)
* ``sources``    - batch and streaming scans, schema files, manifests, generated records
* ``sinks``      - file writers, keyed tables, the processed-file ledger, raw landing
* ``streaming``  - triggers, append and upsert queries, waiting for several queries
* ``plans``      - the jobs a user calls, composed of the layers above
* ``catalog``    - the registered queries with their SQL counterparts
"""

from tableflow.specs import EntitySpec, JobContext, LoadJob, TableSpec

__all__ = ["EntitySpec", "JobContext", "LoadJob", "TableSpec"]
