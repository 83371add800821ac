"""Readers: input files to lines, lines to records, records to meetings, profiles and masters."""
