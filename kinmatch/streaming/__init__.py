"""Incremental runs: resume by anti join, file streams into the matcher."""
