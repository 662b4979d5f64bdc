"""Trip warehouse jobs on Spark: land monthly files, clean them, build and report on a star schema."""
