"""Verified, ordered signal streams as Spark jobs."""
