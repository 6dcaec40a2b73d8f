"""Outputs: appended raw runs, dated archives, retention, published layers, shared scratch tables."""
