"""Streaming in the sense the export uses it: bounded row batches through cursors and writers.

There is no unbounded-stream operator (watermarks, windows, state) in the surveyed tool, so
none is built here; see ``batches`` for the cursor / batch sizing.
"""
