"""Column functions: keys, vectors, DNA strings, prefix sums."""
