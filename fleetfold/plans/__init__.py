"""Physical-plan helpers: skew-safe ordered scans, sized joins, the daily run."""
