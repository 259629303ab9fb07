"""Reading form tabs and seeds, and the raw / staging / marts layer tables."""
