"""DataFrame and column operators of the offer pipeline."""
