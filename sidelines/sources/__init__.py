"""Where the tables come from and where they are written."""
