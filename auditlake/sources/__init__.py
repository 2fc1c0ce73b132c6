"""Reading landed files, small reference tables, and writing results."""
