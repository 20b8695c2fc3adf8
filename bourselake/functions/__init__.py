"""Column-level building blocks: vocabularies, symbols, event time, day masks."""
