"""Empty on purpose: runs of the linkage are batches. ``functions.text.normalise`` works on streams as it is."""
