"""Step factories: each takes its configuration and returns a ``DataFrame -> DataFrame`` step."""
