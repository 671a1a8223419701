"""Readers and writers: text corpora, labelled tables, models."""
