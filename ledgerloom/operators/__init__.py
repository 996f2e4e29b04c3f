"""Relational operators over manifests, queues, statements and pages."""
