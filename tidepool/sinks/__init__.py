"""Writers: files (text, CSV, Parquet, JSON; time-bucketed), message queues, console."""
