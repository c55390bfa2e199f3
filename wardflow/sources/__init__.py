"""Readers, row generators and tables."""
