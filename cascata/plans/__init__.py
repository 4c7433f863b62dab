"""Builders of the derived tables: frames in, frame out, nothing runs."""
