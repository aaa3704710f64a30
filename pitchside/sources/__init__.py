"""Sources and sinks: landed payloads, the bronze log and work queue, synthetic landing from the
driver tables, and layer routing for published tables."""
