"""Named queries, their SQL oracles, materialisation and plan checks."""
