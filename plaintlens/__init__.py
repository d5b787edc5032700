"""Entity-resolved, era-aware complaint analytics as DataFrame-to-DataFrame operators."""
