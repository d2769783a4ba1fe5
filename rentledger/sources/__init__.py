"""Reading operational tables, snapshots and report output."""
