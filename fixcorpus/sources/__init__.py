"""Readers, feeds and sinks: files to rows, records of feeds to findings, results to files."""
