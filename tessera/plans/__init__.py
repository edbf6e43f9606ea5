"""User-level jobs (plans) composed from operators."""
