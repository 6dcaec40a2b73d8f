"""Inputs: typed raw tables, board responses, stored pages, and raw tables made from event data."""
