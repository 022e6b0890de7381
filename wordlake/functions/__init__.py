"""Column functions over words, dates, hashes and rates."""
