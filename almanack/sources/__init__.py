"""Reading and writing raw documents, snapshots and lookup tables."""
