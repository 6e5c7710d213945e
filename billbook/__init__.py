"""Billing feature lake on Spark: raw text to a per-customer feature book."""
