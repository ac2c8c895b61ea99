"""End-to-end batch jobs: features, training, scoring, monitoring."""
