"""Running step pipelines on streams."""
