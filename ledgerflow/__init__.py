"""Retail-banking data loads expressed with the public DataFrame API."""
