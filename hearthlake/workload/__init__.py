"""The registered queries: the library's operators over tables derived from the given test data."""
