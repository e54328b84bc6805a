"""Column expressions on ARRAY<DOUBLE> vectors and the reproducible draw."""
