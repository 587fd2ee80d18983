"""Sources and scans (S1-S9) and the stand-in adapters over the test tables."""
