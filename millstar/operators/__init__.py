"""Operators: cleaning (C1-C10), dimensions (D1-D14), surrogate-key lookups and facts."""
