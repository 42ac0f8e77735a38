"""Composed plans: read views (V1-V7), summary extraction (G6) and end-to-end jobs."""
