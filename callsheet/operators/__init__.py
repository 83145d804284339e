"""Generic operators: staging, keys, segmentation, roll-ups, quality, alerts."""
