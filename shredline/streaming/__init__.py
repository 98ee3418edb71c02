"""Record streams. Beyond batch loads: each micro-batch is one incremental load."""
