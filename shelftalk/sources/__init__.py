"""Readers and writers: delimited tables, dialog files, stored pages, scratch tables."""
