"""End-to-end plans: raw tables to facts, loads, and questions over the mart."""
