"""Whole tables of the lake built from the operators."""
