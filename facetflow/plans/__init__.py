"""End-to-end programs."""
