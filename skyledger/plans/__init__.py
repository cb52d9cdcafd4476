"""The quality rules, the lookups, the star load, its audits and its history."""
