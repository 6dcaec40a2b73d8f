"""Data-quality checks: failing rows, and verdicts on how many there are."""
