"""Message topics, stored tables and the scratch folder."""
