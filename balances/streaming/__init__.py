"""Streaming: intentionally empty.

The workload has no streams, watermarks, event-time windows or state: it is a
monthly full-refresh batch measured against one global cut date. Rows dated
after the cut are handled by the as-of filter and reported by the per-source
cut report (``operators.asof.cut_report``). No streaming operator is added.
"""
