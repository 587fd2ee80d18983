"""Relational operators: best row / top-1 per key, sums, distinct, lookups,
surrogate-key attachment and ranked reads (A1-A9, W1-W4, J1-J6)."""
