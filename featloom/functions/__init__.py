"""Column expressions: null rules, row-wise statistics, special functions, key hashes."""
