"""Training-data operators: tokenizing, quality, privacy, de-duplication and
related work on text tables. Nothing else in the library imports this."""
