"""Inputs: CSV readers with explicit schemas, landed REST snapshots, dated paths."""
