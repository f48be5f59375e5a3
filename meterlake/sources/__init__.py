"""Readers and writers: master CSVs, event lines, Parquet zones, test views."""
