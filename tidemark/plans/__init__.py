"""Partitioned building blocks: blocked scans, halo windows, ordered keyed state."""
