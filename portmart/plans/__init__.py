"""Composite plans: table builders, marts, whole jobs, and the registered query catalog."""
