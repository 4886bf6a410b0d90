"""Operators over DataFrames: merge, outbox, window metrics, dashboard, reports, alerts."""
