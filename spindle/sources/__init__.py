"""Reading raw exports, and the warehouse of stored tables."""
