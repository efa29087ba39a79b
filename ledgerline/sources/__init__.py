"""Readers of landed documents, logs and markup, and writers of logs and reports."""
