"""Readers and writers: delimited sources, truth and prediction files, partitioned and ordered sinks."""
