"""Relational operators over long-form counts: one row per intron and sample."""
