"""Writers: partitioned metrics, wide panels, guarded CSV, tables, INSERT scripts."""
