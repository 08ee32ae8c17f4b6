"""Equipment-telemetry analytics as Spark DataFrame operators.

Sub-packages:

* ``functions`` - column expressions (checks, timestamps, scores, signals)
* ``sources``   - readers, ingest metadata, table writes, upsert, contracts
* ``operators`` - DataFrame -> DataFrame stages (clean, enrich, anomalies,
  KPIs, health, alerts, fleet, flotation, failures, signals, quality)
* ``plans``     - report queries, the layered bronze/silver/gold run and the
  bindings to the benchmark tables
* ``streaming`` - incremental file ingest and windowed streaming KPIs
"""

__version__ = "0.1.0"
