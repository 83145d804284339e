"""Column-level building blocks: rule tables, conversion measures, time."""
