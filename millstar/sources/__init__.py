"""Sources: payload landing (S1), versioned snapshots and Parquet IO (S2-S7), table listing."""
