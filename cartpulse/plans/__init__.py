"""Composite, user-visible results (dashboard) and the query catalog."""
