"""Streaming.

The reference reads only batch files: no stream, watermark or state exists
in it, so nothing stateful is built here. The toolkit's per-row pieces
(``contrail.functions``: token replacement, tolerant casts, clock
conversion and the clock filter) are plain Column expressions and apply
unchanged to a Structured Streaming DataFrame; the decisions that need a
whole-table profile (sparse/constant columns, index labels, scaling
bounds) are taken on batch data first and then replayed as projections
(``tests/test_streaming.py`` shows this).
"""
