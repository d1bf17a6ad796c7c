"""Whole pipelines: the step runner and ready-made plans."""
