"""Keyframe annotations to training records, as Spark jobs."""
