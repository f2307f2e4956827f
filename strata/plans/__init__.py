"""Composites: the layered flow, the step runner, and the test-table mapping."""
