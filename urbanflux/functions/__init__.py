"""Column expressions: keys, buckets, validation rules. No user-defined functions."""
