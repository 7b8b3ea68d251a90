"""Row-level building blocks that stay even when one key holds much of the data."""
