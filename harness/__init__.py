"""Correctness harness: adapter tables, registered queries and their SQL oracles."""
