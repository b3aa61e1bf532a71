"""Readers and writers: driver tables, derived fixtures, sheets, stores."""
