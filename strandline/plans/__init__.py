"""End-to-end pipelines composed of operators."""
