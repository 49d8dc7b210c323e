"""Writers for the fact, the dimensions and dated snapshots, and the serving catalog."""
