"""Reading inputs and writing reports."""
