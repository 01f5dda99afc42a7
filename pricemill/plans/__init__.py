"""The three commodity families: raw reports to a typed table, and the questions asked of it."""
