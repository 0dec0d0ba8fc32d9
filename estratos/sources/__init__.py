"""Reading landed files and writing layers."""
