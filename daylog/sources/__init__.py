"""Landed documents, stored tables and their upserts."""
