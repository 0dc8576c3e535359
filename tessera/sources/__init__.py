"""Readers and writers: strict and lenient JSON, CSV, whole files, and tables by key."""
