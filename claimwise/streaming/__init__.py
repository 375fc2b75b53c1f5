"""Streaming execution of the export chain.

The reference has no streaming operators (no watermarks, windows over event
time or state).  Its export is a row pipeline: scan -> filter -> enrich ->
write, and every step is stateless per row or a join with a static lookup.
``export.start_export_stream`` runs the same steps on a streaming file source.
"""
