"""Reading raw files and staged tables, writing staged and warehouse tables."""
