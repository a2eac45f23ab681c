"""Readers, writers and stores."""
