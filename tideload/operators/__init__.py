"""Table operators: latest row per key, merges, lookups, numbering, updates, publishing."""
