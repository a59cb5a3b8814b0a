"""Writing tables and publishing a run."""
