"""Writers of the reports."""
