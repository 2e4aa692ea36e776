"""Episode operators: ordering, quality, splits, indexes, slices, frames, signals."""
