"""Table writers: partitioned feature table, scored table, plain and CSV exports."""
