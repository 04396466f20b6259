from basketlab.sinks.writers import write_csv, write_snapshot, write_table

__all__ = ["write_csv", "write_snapshot", "write_table"]
