"""Relational operators: staging, transforms, benchmarks, report, quality."""
