"""Sources: the test tables, raw frame feeds, streams and landing-zone replay."""
