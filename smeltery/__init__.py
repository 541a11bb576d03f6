"""Layered (bronze to silver) table refinement written as plain Spark jobs."""
