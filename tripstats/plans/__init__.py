"""Query plans: the six questions, their test-table carriers, the pipeline."""
