"""Streaming jobs, their keyed tables, and delivery to an outside store."""
