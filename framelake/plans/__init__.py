"""Chunk planning and composed jobs."""
