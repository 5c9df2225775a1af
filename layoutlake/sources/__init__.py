"""Readers that give pages, regions, lexicons and report rows as DataFrames."""
