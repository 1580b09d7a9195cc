"""Readers and writers: labelled text lines, feature tables partitioned by split, the result table."""
