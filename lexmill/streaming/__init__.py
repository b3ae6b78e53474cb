"""Structured Streaming forms of roll-ups: windowed stage totals and the latest revision of each section."""
