"""DataFrame operators: lookups, reshapes, fills, numbering and upserts."""
