"""The query catalogue over the stored tables and its SQL oracle."""
