"""Kept empty on purpose: the warehouse is batch only (no stream, window or state exists in its workload)."""
