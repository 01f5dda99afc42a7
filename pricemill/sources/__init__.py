"""Readers. All of them run on executors; none lists or opens files in Python."""
