"""Column expressions (no UDFs): fiscal dates, ids, calendar, weather, tiers."""
