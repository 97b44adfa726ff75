"""Structured Streaming entry points.

The reference has no streaming operator; its "real-time scoring" is batch
scoring of saved sequences (M6).  ``scoring.score_stream`` applies that same
fitted model + tiered decision to a stream of ready sequence rows -- no new
operator, only the M6 job on micro-batches.
"""
