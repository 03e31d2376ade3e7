"""Commit-text analytics as ordinary Spark DataFrame functions."""
