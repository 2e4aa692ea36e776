"""End-to-end jobs: convert, inspect or validate, replay."""
