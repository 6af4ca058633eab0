"""Whole workflows and the registered queries."""
