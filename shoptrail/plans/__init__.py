"""End-to-end plans: the pipeline stages wired over the test tables."""
