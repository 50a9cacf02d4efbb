"""DataFrame to DataFrame transforms. None of them reads, writes or starts a job unless its text says so."""
