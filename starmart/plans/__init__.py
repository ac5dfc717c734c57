"""End-to-end jobs: read, transform, check, write."""
