"""Report queries, the layered run, and the benchmark-table bindings."""
