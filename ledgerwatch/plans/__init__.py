"""The two jobs: first set-up and the daily run."""
