"""Thin ``spark-submit`` entry points; the session comes from the submit command."""
