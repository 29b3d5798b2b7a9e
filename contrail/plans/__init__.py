"""End-to-end pipelines, their parameters, and the registered query set."""
