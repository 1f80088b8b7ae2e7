"""Readers: message sources, partitioned lake tables, tracking tables."""
