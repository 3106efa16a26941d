"""Available-now streaming form of the incremental run."""
