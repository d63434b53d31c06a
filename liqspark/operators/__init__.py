"""DataFrame operators: cleaning, pairing, medians, distributed rank, windows."""
