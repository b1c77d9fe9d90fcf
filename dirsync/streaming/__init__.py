"""Stream jobs."""
