"""Generic DataFrame operators; the quality rules are settings of these."""
