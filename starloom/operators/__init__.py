"""DataFrame -> DataFrame operators: ranking, dedup, quarantine, lookups, profiles."""
