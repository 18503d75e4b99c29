"""Submissions arriving as a stream of files."""
